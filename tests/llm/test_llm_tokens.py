"""Encoding by parts and N-best segmentation against the libraries and enumeration."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidepool.llm.encoders import PartEncoder
from tidepool.llm.nbest import SPACE, Segmenter, decode_ids, encode_nbest, nbest_digests
from tidepool.llm.packing import Filling, nnls, patterns, plan
from tidepool.llm.queries import QUERIES

PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_parts_give_the_ids_of_the_whole(name, spark, sf_dir):
    rng = random.Random(1)
    alphabet = " \n\t\xa0　ÄÖüßêA.'s1é́İΣσ<|endoftext|>​\x1c\x85\r中,"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a <|endoftext|> b", "", " ", "x" * 20_000, *(r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect())]
    encoder = PartEncoder(public_tokenizers.path(name))
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    for _ in range(2):  # the second time from what is kept
        ids, sizes = encoder.encode(pa.array(texts))
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def model():
    return Segmenter(PIECE)


def _all(model, text):
    marked = SPACE + text.replace(" ", SPACE) if text else ""
    edges = {}
    for i, j, score in model.edges(marked):
        edges.setdefault(i, []).append((j, score))
    found = []

    def walk(at, score, ids):
        if at == len(marked):
            found.append((score, tuple(ids)))
        for j, s in edges.get(at, []):
            walk(j, score + s, [*ids, *model.piece_ids(marked[at:j])])

    walk(0, 0.0, [])
    return sorted(found, reverse=True)


def test_nbest_against_all_segmentations(model):
    rng = random.Random(3)
    for _ in range(150):
        text = "".join(rng.choice("abtheon in .,\n é▁") for _ in range(rng.randint(0, 11)))
        every = _all(model, text)
        got = model.nbest([text], 4)[0]
        assert [s for s, _ in got] == [s for s, _ in every[:4]]
        ids = [tuple(np.frombuffer(x, np.uint32).tolist()) for _, x in got]
        assert len(set(ids)) == len(ids) and {(s, i) for (s, _), i in zip(got, ids, strict=True)} <= set(every)
        assert all(model.decode(list(i)) == text.replace(SPACE, " ") for i in ids)


def _best_scores(model, text, n_best):
    """Scores of the ``n_best`` segmentations of a whole text, by the best scores up to each place."""
    marked = SPACE + text.replace(" ", SPACE) if text else ""
    best = [[0.0]] + [[] for _ in marked]
    for i, j, score in model.edges(marked):
        best[j] = sorted(best[j] + [x + score for x in best[i]], reverse=True)[:n_best]
    return best[-1]


def test_nbest_query_against_whole_texts(spark, sf_dir, model):
    got = {}
    for r in QUERIES["op3_nbest"](spark, sf_dir).collect():
        got.setdefault(r["doc_id"], {})[r["rank"]] = r
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert got.keys() == texts.keys()
    for doc, text in texts.items():
        want = _best_scores(model, text, 4)
        rows = [got[doc][k] for k in range(len(want))]
        assert len(got[doc]) == len(want) and [r["score"] for r in rows] == pytest.approx(want, rel=1e-12)
        assert all(r["round_trip"] for r in rows)


def test_equal_scores_and_long_stretches(spark, model):
    for n in (1, 7, 90, 1001):
        text = SPACE + "a" * n
        got = model.search(text, 6)
        assert [s for s, _ in got] == _best_scores(model, "a" * n, 6) and len({i for _, i in got}) == len(got)
        lengths = [[-len(model.surface[k]) for k in np.frombuffer(i, np.uint32)[::-1]] for _, i in got]
        assert sorted(zip([-s for s, _ in got], lengths, strict=True)) == list(zip([-s for s, _ in got], lengths, strict=True))
    rows = nbest_digests(spark.createDataFrame([(1, "a" * 1_000_000), (2, "b" * 300_000)], "doc_id bigint, text string"), PIECE, 4).collect()
    assert len(rows) == 8 and len({(r["doc_id"], r["ids_crc32"]) for r in rows}) == 8 and all(r["round_trip"] for r in rows)


def test_memory_of_a_stretch_grows_with_its_length(model):
    peaks = []
    for n in (40_000, 160_000):
        tracemalloc.start()
        model.search(SPACE + "a" * n, 4)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 5 * peaks[0] and peaks[1] < 1000 * 160_000


def test_texts_together_and_alone(model):
    words = ["there", "Reoush.", "x" * 70, "Über", "中文", "a\nb"]
    assert [(u.ids, u.score, u.gap) for u in model.solve_all(words)] == [(u.ids, u.score, u.gap) for u in map(model.solve, words)]
    texts = [" ".join(words), "", "  two  spaces ", "▁"]
    assert model.nbest(texts, 3) == [Segmenter(PIECE).nbest([t], 3)[0] for t in texts]


def test_round_trip_of_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(None, "a b"), (-1, None), (-2, "")], "doc_id bigint, text string"))
    encoded = encode_nbest(docs, PIECE, 2)
    texts = {(r["doc_id"], r["text"] or "") for r in docs.collect()}
    assert {(r["doc_id"], r["text"]) for r in decode_ids(encoded, PIECE).collect()} == texts
    assert encode_nbest(docs.where("doc_id = -9"), PIECE, 2).count() == 0
    assert encoded.where(F.col("doc_id") == -1).collect()[0]["ids"] == []


def test_nnls_and_patterns():
    forms = patterns(12)
    weight = np.arange(1, 13) @ forms
    assert (weight == 12).all() and forms.shape[1] == len(set(map(tuple, forms.T)))
    rng = np.random.default_rng(4)
    a, x = rng.random((20, 8)), np.maximum(rng.normal(size=8), 0)
    assert np.allclose(nnls(a, a @ x), x, atol=1e-8)
    b = rng.normal(size=20)
    y = nnls(a, b)
    gain = a.T @ (b - a @ y)
    assert (y >= 0).all() and gain.max() < 1e-6 and abs(gain[y > 0]).max(initial=0) < 1e-6


def test_patterns_never_cost_sequences():
    rng = np.random.default_rng(5)
    for capacity, spread in ((40, 3), (100, 30), (2048, 400), (2048, 4000)):
        lengths = np.clip(rng.exponential(spread, 4000).astype(int) + 1, 1, capacity)
        counts = Counter(lengths.tolist())
        rows = plan(counts, capacity)
        alone = Filling(counts, capacity)
        for length in range(capacity, 0, -1):
            alone.best_fit(length)
        assert max(first + n for *_, first, n, _ in rows) <= alone.sequences
        placed = Counter()
        for length, low, high, *_ in rows:
            placed[length] += high - low
        assert placed == counts
