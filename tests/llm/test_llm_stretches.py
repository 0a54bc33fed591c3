"""Stretches are sent once, each once a text, and hot and other runs give what all stretches give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import substring_dedup as SD


def rows_of(seed):
    rng = np.random.default_rng(seed)
    common = [" ".join(rng.choice(list("abcdefgh"), 90)) for _ in range(3)]
    rows = [(i // 2 if i < 6 else i, f"{' '.join(rng.choice(list('abcdefgh'), 20))} {common[i % 3]} {i}") for i in range(40)]
    return [*rows, (None, rows[9][1]), (None, "same " * 150), (50, "same " * 120 + "end"), (51, common[0] + "\n" + common[0]), (52, None)]


def brute(rows, min_words):
    first, last, out = {}, 1 << 62, []
    listed = [(i, t, *SD.words(t or "")) for i, t in rows]
    listed = [(i, t, [t[a:b] for a, b in zip(s, e[min_words - 1 :], strict=False)] if t else []) for i, t, s, e in listed]
    for i, _, found in listed:
        for x in found:
            first[x] = min(first.get(x, last), last if i is None else i)
    for i, t, found in listed:
        out.append((i, t, SD.spans(t, [k for k, x in enumerate(found) if first[x] < (last if i is None else i)], min_words) if t else []))
    return out


@pytest.mark.parametrize("hot", [3, 13, 10_000])
@pytest.mark.parametrize("min_words", [5, 51])
def test_hot_and_other_runs_against_all_stretches(spark, monkeypatch, min_words, hot):
    monkeypatch.setattr(SD, "HOT_ROWS", hot)
    rows = rows_of(min_words)
    got = SD.dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string"), min_words).collect()
    found = sorted(((r["doc_id"], [(s["start"], s["end"]) for s in r["removed"]]) for r in got), key=str)
    want = brute(rows, min_words)
    assert found == sorted(((i, spans) for i, _, spans in want), key=str) and any(spans for _, _, spans in want)


def test_stretches_go_to_their_digest_once(spark, monkeypatch):
    written = []
    kept = SD.materialized
    monkeypatch.setattr(SD, "materialized", lambda df, label: (written.append(df.columns), kept(df, label))[1])
    out = SD.dedup_substrings(spark.createDataFrame(rows_of(1), "doc_id bigint, text string"))
    assert not any("high" in columns for columns in written)
    assert out.where(F.size("removed") > 0).count() > 30


def test_a_stretch_is_sent_once_a_text():
    text = np.array([0, 0, 0, 1, 1, 2])
    place = np.array([3, 5, 9, 3, 4, 0])
    digests = np.array([[1, 7], [2, 7], [1, 7], [1, 7], [1, 8], [1, 7]])
    kept, more = SD.once(text, place, digests)
    assert kept.tolist() == [0, 1, 3, 4, 5] and more == [[9], None, None, None, None]
    kept, more = SD.once(text[1:4], place[1:4], digests[1:4])
    assert kept.tolist() == [0, 1, 2] and more == [None, None, None]
    assert SD.once(text[:0], place[:0], digests[:0])[1] == []
