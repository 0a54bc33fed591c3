"""The conversation trie against its definition, with containers that burst and conversations of many segments."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidepool.llm.burst_trie import RESULT, conversation_trie
from tidepool.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, head int"


def _tie(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def _brute(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            given[conv].append(((turn is not None, turn or 0, _tie(role, text)), (role, text)))
    own = {c: [x for _, x in sorted(turns)] for c, turns in given.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        kids = [below[k] for k in children[node]]
        below[node] = (sum(k[0] for k in kids) or 1, sum(k[1] for k in kids) + (len(members[node]) - 1) * words)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def _got(df):
    return sorted(str(tuple(r[c] for c in RESULT)) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    out = []
    for c in [*range(0, 90), -5, -20, -41, 4095, 4096, 4100, 1 << 40]:
        if c in (20, 60):  # families without a first conversation
            continue
        n = rng.choice([1, 2, 3, 4, 6, 9])
        shape = rng.random()
        for t in range(n):
            text = f"turn {t} of a template" if shape < 0.6 else f"words {rng.randint(0, 1)}\tand\x0bmore"
            out.append((c, t if shape < 0.9 else t // 2, "user" if t % 2 else "assistant", text))
    out += [(7, None, None, None), (7, None, "user", ""), (7, 99, None, "  \n "), (None, 1, "user", "nobody's"), (8, 3, "user", "x " * 30_000)]
    out += [(40, t, "user", f"same {t}") for t in range(50, 70)] + [(41, t, "user", f"same {t}") for t in range(50, 70)]  # long ones, shared
    out += [(88, t, "user", "again") for t in range(100, 140)]  # a long one, alone
    out += out[:5]  # repeated rows are repeated turns
    return out


@pytest.mark.parametrize(("segment", "container"), [(4096, 5000), (4096, 3), (3, 2)])
def test_trie_equals_its_definition(spark, rows, segment, container):
    turns = spark.createDataFrame([(*r, "depth", 3) for r in rows], SCHEMA).repartition(5)
    assert _got(conversation_trie(turns, segment, container)) == _brute(rows)


def test_trie_of_the_table(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = QUERIES["op12_trie"](spark, sf_dir)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 7 + ["string"]
    assert _got(got) == _brute([tuple(t) for t in turns])


def test_many_copies_end_in_order(spark):
    """More copies than a block of ends holds."""
    turns = spark.range(1, 9_000, 2).select(F.col("id").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("hello").alias("text"))
    rows = [tuple(r) for r in turns.collect()]
    assert _got(conversation_trie(turns)) == _brute(rows)


def test_empty_tables(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert conversation_trie(turns).count() == 0
    assert conversation_trie(spark.createDataFrame([(None, 1, "user", "x", "", 1)], SCHEMA)).count() == 0
