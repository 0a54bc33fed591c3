"""The filter audit against its definitions, one document at a time, and on difficult rows."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidepool.llm import filter_audit
from tidepool.llm.queries import QUERIES

LONG = " ".join(f"w{i}" for i in range(120))
ROWS = [
    (1, LONG, "en"),
    (1, LONG, "en"),  # the same document twice
    (2, LONG, "en"),
    (3, LONG, "de"),
    (None, LONG, None),
    (None, LONG, "en"),
    (4, None, "en"),
    (5, "", "en"),
    (None, "only here, without a number", "de"),
    (None, "only here, without a number", "de"),
    (6, "lang " * 40_000, "en"),
    (7, "SHOUT " * 100 + "#", ""),
    (8, "a b\x1cc \x0bd &", None),
    (9, LONG + " é $", "fr"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, None, None), (7, 0, 1), (None, 1, 1), (99, 1, 1)]


def _brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    ids = {}
    for i, text, _ in rows:
        ids.setdefault(text or "", set()).add(i)
    failing = []
    for i, text, lang in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        known = [k for k in ids[t] if k is not None]
        failed = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": bool(known) and (i is None or i > min(known)),
        }
        failing.append((lang or "", {f for f, bad in failed.items() if bad}, i in good, i in toxic))
    out, shapley = Counter(), Counter()
    for part in {f[0] for f in failing}:
        for order in map("".join, permutations("ABCDE")):
            for k, letter in enumerate(order):
                for p, bad, g, t in failing:
                    if p == part:
                        before = bool(bad & set(order[:k]))
                        first = letter in bad and not before
                        key = (part, order, k + 1)
                        out[key, "kept"] += not before and letter not in bad
                        out[key, "removed"] += first
                        out[key, "redundant"] += letter in bad and before
                        out[key, "unique_fails"] += bad == {letter}
                        out[key, "good_lost"] += first and g
                        out[key, "toxic_lost"] += first and t
                        shapley[part, letter] += first
    return out, shapley


def _check(rows, out, shapley):
    assert len(rows) * 6 == len(out)
    for r in rows:
        for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
            assert r[c] == out[(r["part"], r["filter_order"], r["step"]), c], (r, c)
        assert r["shapley"] == shapley[r["part"], r["filter_order"][r["step"] - 1]]


def test_audit_of_difficult_rows(spark):
    docs = spark.createDataFrame([(i, t, p, 7, "x") for i, t, p in ROWS], "doc_id bigint, text string, lang string, part int, mask string")
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    _check(filter_audit.audit(docs, labels).collect(), *_brute(ROWS, LABELS))


def test_audit_query_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()
    got = QUERIES["op13_filter_audit"](spark, sf_dir)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "int"] + ["bigint"] * 7
    _check(got.collect(), *_brute([tuple(d) for d in docs], [tuple(x) for x in labels]))


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "x", None)], docs.schema)
    assert filter_audit.audit(one, labels).where("removed > 0").agg(F.sum("removed")).first()[0] == 120


@pytest.mark.parametrize("n", [1, 3, 1 << 40])
def test_packed_fields_do_not_overflow(n):
    total = sum(filter_audit.packed(mask, True, True) * n for mask in range(32))
    steps = filter_audit.unpacked(total)
    assert steps[0, 0] == 16 * n and steps[1, 0] == 8 * n and steps[1, 1] == 8 * n
    assert (steps[:, 0] == steps[:, 2]).all() and (steps[:, 0] == steps[:, 3]).all()
    rows = filter_audit.part_rows("p", [(31, False, False, n)])
    assert set(rows["shapley"].tolist()) == {24 * n}
