"""The tokenization automaton against merging step by step and against the library."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from tokenizers import Tokenizer

from tidepool.llm import merge_automaton
from tidepool.llm.merge_automaton import AutomatonEncoder, Decoder, MergeAutomaton, decode_documents, encode_documents, round_trip
from tidepool.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [
    (1, "It's the cat's mat; we'll see  what they've \n\n\t done...", "en"),
    (1, "It's the cat's mat; we'll see  what they've \n\n\t done...", "en"),
    (1, "other text, same number", "x"),
    (None, "no number", None),
    (2, None, "en"),
    (3, "", "en"),
    (4, " \n\t ", None),
    (5, "a<|endoftext|>b <|endoftext|><|endoftext|> c<|endoftext|", "en"),
    (6, "漢字 😀 é ́  　 ½ ²³ ٣٤ x\x00y\r\n", "zh"),
    (7, "a" * 200_000, "en"),
    (8, "-=" * 50_000, "en"),
    (9, "word " * 60_000, "en"),
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def made():
    return AutomatonEncoder(PATH)


def _merged(word, rules):
    """Merging step by step: the lowest rank first, from the left."""
    parts = list(word)
    while True:
        known = [(rules[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rules]
        if not known:
            return parts
        _, i = min(known)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=25), st.lists(st.text("abc", max_size=14), max_size=12))
@settings(max_examples=300, deadline=None)
def test_automaton_equals_merging(picks, words):
    """Over random merge tables, runs of equal letters included; the automaton accepts just the merged form."""
    tokens, rules = ["a", "b", "c"], {}
    for x, y in picks:
        u, v = tokens[x % len(tokens)], tokens[y % len(tokens)]
        if u + v not in tokens:
            rules[u, v] = len(rules)
            tokens.append(u + v)
    number = {t: i for i, t in enumerate(tokens)}
    auto = MergeAutomaton({i: t.encode() for t, i in number.items()}, [(number[u], number[v], number[u + v]) for u, v in rules])
    for word in words:
        want = [number[p] for p in _merged(word, rules)]
        assert auto.encode(word.encode()) == want
        q = 0
        for t in want:
            assert auto.arc(q, t)
            q = auto.target[t]


def test_difficult_rows(spark, tokenizer):
    docs = spark.createDataFrame([(i, t, lang, b"x", 1) for i, t, lang in ROWS], "doc_id bigint, text string, lang string, ids binary, key int")
    got = round_trip(docs, PATH).collect()
    want = [(i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes(), t or "") for i, t, _ in ROWS]
    assert sorted(map(str, ((r["doc_id"], bytes(r["ids"]), r["text"]) for r in got))) == sorted(map(str, want))
    assert sorted(map(str, decode_documents(encode_documents(docs, PATH), PATH).collect())) == sorted(str(Row(doc_id=i, text=t)) for i, _, t in want)
    assert round_trip(docs.where("doc_id = -1"), PATH).count() == 0


def test_query_on_the_table(spark, sf_dir, tokenizer):
    got = {r["doc_id"]: r for r in QUERIES["op11_automaton"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@given(st.lists(st.text(st.sampled_from("abEth  \n\t.,'’é漢😀01!?-=　 "), max_size=30), max_size=20))
@settings(max_examples=150, deadline=None)
def test_random_texts_equal_the_library(made, tokenizer, texts):
    for text in texts:
        assert made._ids(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_table_is_begun_anew(monkeypatch, made, tokenizer):
    monkeypatch.setattr(merge_automaton, "KEPT_PLACES", 40)
    made.automaton._forget()
    for text in ("unbelievablyinterchangeable" * 20, "Straßenbahnhaltestelle", "xyzzyqwertyuiop" * 9):
        assert made._ids(text) == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(made.automaton.places) <= 41
    made.automaton._forget()


def test_decoding_any_ids(tokenizer):
    """Bytes that are no UTF-8 included."""
    emit = Decoder(PATH).decode
    rng = np.random.default_rng(5)
    for _ in range(300):
        ids = rng.integers(0, 50_257, 12)
        assert emit(ids).decode("utf-8", "replace") == tokenizer.decode(ids.tolist(), skip_special_tokens=False)


def test_merge_tables_that_are_no_order_are_refused():
    with pytest.raises(ValueError):
        MergeAutomaton({0: b"a", 1: b"aa", 2: b"aaa"}, [(1, 0, 2), (0, 0, 1)])
    with pytest.raises(ValueError):
        MergeAutomaton({0: b"a", 1: b"aa", 2: b"aaa"}, [(0, 0, 1), (1, 0, 2), (0, 1, 2)])
