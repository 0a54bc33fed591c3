"""Substring de-duplication: passages of ``min_words`` words or more that one earlier document holds.

A passage is a stretch of text from the start of a word to the end of one, equal character by character; words
stand between white space. Every word that lies in a stretch of ``min_words`` words found whole in a document
with a smaller id is removed, so the first document keeps a passage, shorter common phrases stay everywhere, and
the borders are those of the common text, to the word.

Search: texts are cut into chunks of words by their content. A gear hash rolls over the words (each word's hash is its gear
value) and forgets a word after ``memory`` more; of every ``window`` places in a row, those of the least hash are
cuts. So a chunk has at most ``window`` words, and whether a place is a cut depends on the words near it alone: inside a
passage that two texts share, all cuts are the same but for ``memory`` + ``window`` words at its start and ``window`` at its end,
whatever was inserted elsewhere. ``shape`` chooses both so short that a stretch of ``min_words`` words always holds a
whole run of ``run`` chunks there. A stretch stands for the least digest among its runs of chunks, equal stretches for
equal ones, neighbours mostly for the same. These are de-duplicated by digest over the corpus. Check: only stretches whose
run occurs in several documents are themselves compared, by a digest of 128 bits of their characters. They are sent
once, to their digest, where the smallest id goes through all rows of it.

A chunk or stretch that very many rows hold is joined without a shuffle by it: there are at most ``HOT_KEYS`` of these. A
stretch is in no more rows than its run of chunks, so the counts of the runs tell which may be hot.

Null texts stay null, empty ones empty. Null ids come after all others. Rows with equal ids are one
document: they never make each other's passages repeats, and each loses what earlier documents hold. Repeats
within a document stay. All columns are kept; names of the result's own columns are replaced. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidepool.llm.common import by_bytes, map_batches, whole_text
from tidepool.session import materialized

#: The fewest words of a passage: over 50.
MIN_WORDS = 51
#: A key of more than so many rows, and more than one in ``HOT_KEYS`` of all rows, is hot.
HOT_ROWS, HOT_KEYS = 10_000, 200_000
#: Characters of the texts that are cut together.
GROUP = 500_000
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Factors of the rolling hash: a number and its inverse modulo 2^64.
_STEP = 0xD1342543DE82EF95
_BACK = pow(_STEP, -1, 1 << 64)


def edges(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some code points start and end."""
    space = np.concatenate([[True], _SPACE[np.minimum(points, len(_SPACE) - 1)], [True]])
    edge = np.diff(space.astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end."""
    return edges(np.frombuffer(text.encode("utf-32-le"), "<u4"))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the rolling hash's factor and of its inverse."""
    both = []
    for factor in (_STEP, _BACK):
        out = np.full(n, factor, np.uint64)
        out[:1] = 1
        both.append(np.cumprod(out, dtype=np.uint64))
    return both[0], both[1]


def shape(min_words: int) -> tuple[int, int, int]:
    """Words that the gear hash remembers, places of which one is a cut, and chunks in a run.

    Inside a stretch the places from ``memory + window - 2`` to ``min_words - window`` have the same cuts in every text.
    They are at least ``run + 1`` times ``window``, so as many cuts are among them, and a whole run between these.
    """
    if min_words < 2:
        raise ValueError("a passage has two words at least")
    memory = min(5, max(1, min_words // 10))
    run = 4 if min_words >= 20 else 1
    return memory, max(1, (min_words + 3 - memory) // (run + 3)), run


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift in (30, 27):
        h = (h ^ (h >> np.uint64(shift))) * _MIX
    return h


def _sliding(h: np.ndarray, window: int, choose: np.ufunc) -> np.ndarray:
    """``choose`` over every ``window`` values in a row, by ever wider windows."""
    size = 1
    while size < window:
        step = min(size, window - size)
        h = choose(h[:-step], h[step:])
        size += step
    return h


class Chunks:
    """Content-defined chunks of texts. Places are words, counted over all of them; ``reps`` belong to the stretches ``at``."""

    def __init__(self, texts: list[str], min_words: int):
        memory, window, run = self.memory, self.window, self.run = shape(min_words)
        points = np.frombuffer(" ".join(texts).encode("utf-32-le"), "<u4")
        self.starts, self.ends = edges(points)
        n = len(self.starts)
        first = np.searchsorted(self.starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        self.text = np.repeat(np.arange(len(texts)), np.diff(first))
        self.first = first[self.text]
        left = first[self.text + 1] - np.arange(n)
        self.at = np.flatnonzero(left >= min_words)
        # bytes before each code point, for the digests
        self.bytes = np.concatenate([[0], np.cumsum(1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000))])
        self.cuts, self.reps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.at):
            return
        up, down = powers(len(points) + 1)
        values = (points.astype(np.uint64) + np.uint64(1)) * _ODD
        values ^= values >> np.uint64(29)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)])

        def hashed(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
            return _mixed((total[ends] - total[starts]) * down[starts])

        gear, shift = hashed(self.starts, self.ends), -(-64 // memory)
        rolled = gear.copy()
        for k in range(1, memory):  # the word k places back has been shifted k times
            rolled[k:] += gear[:-k] << np.uint64(k * shift)
        h = _mixed(rolled) | np.uint64(1)
        least = _sliding(h, window, np.minimum)
        whole = (np.arange(n) - self.first >= memory - 1) & (left >= window)  # windows of one text
        edge = np.zeros(window - 1, np.uint64)
        of_windows = _sliding(np.concatenate([edge, np.where(whole[: len(least)], least, np.uint64(0)), edge]), window, np.maximum)
        self.cuts = np.flatnonzero(of_windows == h)
        # at the end a sentinel, so that every stretch's range of runs has an end
        runs = np.append(hashed(self.starts[self.cuts[:-run]], self.ends[self.cuts[run:] - 1]), np.uint64(0))
        low = np.searchsorted(self.cuts, self.at + memory + window - 2)
        high = np.searchsorted(self.cuts, self.at + min_words - window, side="right") - run
        self.reps = np.minimum.reduceat(runs, np.stack([low, high], axis=1).ravel())[::2].view(np.int64)

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Texts and the runs that stand for their stretches, each once."""
        text = self.text[self.at]
        new = np.concatenate([[True], (self.reps[1:] != self.reps[:-1]) | (text[1:] != text[:-1])])[: len(text)]
        text, reps = text[new], self.reps[new]
        order = np.lexsort((reps, text))
        text, reps = text[order], reps[order]
        once = np.concatenate([[True], (reps[1:] != reps[:-1]) | (text[1:] != text[:-1])])[: len(text)]
        return text[once], reps[once]


def grouped(texts: list[str], min_words: int) -> Iterator[tuple[int, list[str], Chunks]]:
    """Chunks of neighbouring texts together, with the number of texts before them."""
    before = 0
    for group in by_bytes(texts, GROUP):
        yield before, group, Chunks(group, min_words)
        before += len(group)


def joined(rows: DataFrame, held: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Inner join of ``rows`` with ``held``: ``keys``, the number ``n`` of rows that have them, and more; hot keys are split up.

    Of the keys, those to ``keep`` are in the result, and ``_is_hot``.
    """
    held = materialized(held, "held")
    hot_from = max(HOT_ROWS, (held.agg(F.sum("n")).first()[0] or 0) // HOT_KEYS)
    more = [c for c in held.columns if c not in (*keys, "n")]
    hot = held.where(F.col("n") > hot_from).select(F.lit(True).alias("_hot"), *(F.col(c).alias(f"_hot_{c}") for c in (*keys, *more)))
    cold = held.where(F.col("n") <= hot_from).select(*keys, F.lit(False).alias("_is_hot"), F.lit(True).alias("_found"), *more)
    # fewer than HOT_KEYS rows, as their counts add up
    known = rows.join(F.broadcast(hot), reduce(and_, [F.col(k) == F.col(f"_hot_{k}") for k in keys]), "left")
    known = known.withColumn("_is_hot", F.coalesce("_hot", F.lit(False))).drop("_hot", *(f"_hot_{k}" for k in keys if k not in keep))
    # hot rows are done: they are dealt out by what they are, and find nothing
    known = known.withColumn(keys[0], F.when(F.col("_is_hot"), F.xxhash64("id", "th")).otherwise(F.col(keys[0])))
    found = known.join(cold, [*keys, "_is_hot"], "left").where(F.col("_is_hot") | F.col("_found"))
    return found.select("id", "th", "_is_hot", *(c for c in rows.columns if c not in ("id", "th", *keys)), *(F.coalesce(F.col(f"_hot_{c}"), F.col(c)).alias(c) for c in (*keep, *more)))


def shared_chunks(rows: DataFrame, min_words: int) -> DataFrame:
    """``id``, ``th``, ``chunks`` and ``hot``: digests of the runs of chunks of a text that other documents have too, and of hot ones."""

    def find(batch: pa.RecordBatch) -> dict:
        taken, chunks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for before, _, c in grouped(batch.column("text").to_pylist(), min_words):
            text, reps = c.marks()
            taken.append(before + text)
            chunks.append(reps)
        order = pa.array(np.concatenate(taken))
        return {"id": batch.column("id").take(order), "th": batch.column("th").take(order), "chunk": np.concatenate(chunks)}

    kind = rows.schema["id"].dataType.simpleString()
    chunks = map_batches(rows, find, f"id {kind}, th bigint, chunk bigint")
    held = chunks.groupBy("chunk").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.max(F.col("id").isNull()).alias("some_null"), F.count("*").alias("n"))
    several = (F.col("first") < F.col("last")) | (F.col("first").isNotNull() & F.col("some_null"))
    found = joined(chunks, held.where(several).select("chunk", "n"), ["chunk"], ["chunk"])
    parts = {"chunks": ~F.col("_is_hot"), "hot": F.col("_is_hot")}
    return found.groupBy("id", "th").agg(*[F.collect_set(F.when(which, F.col("chunk"))).alias(name) for name, which in parts.items()])


def stretches(rows: DataFrame, min_words: int) -> DataFrame:
    """``id``, ``th``, ``place``, ``more``, ``high`` and ``low``: the stretches of a text whose run is among its ``chunks``, each once.

    ``place`` is the word at which a stretch first starts, ``more`` has the others, if any.
    """

    def compare(batch: pa.RecordBatch) -> dict:
        listed = batch.column("chunks")
        shared = np.unique(listed.flatten().to_numpy()) if len(listed) else np.zeros(0, np.int64)
        taken, places, halves, more = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)], []
        for before, texts, c in grouped(batch.column("text").to_pylist(), min_words):
            at = c.at[np.isin(c.reps, shared)]
            data = memoryview(" ".join(texts).encode())
            bounds = zip(c.bytes[c.starts[at]].tolist(), c.bytes[c.ends[at + min_words - 1]].tolist(), strict=True)
            digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[i:j]) for i, j in bounds]), ">i8").astype(np.int64).reshape(-1, 2)
            text, place = c.text[at], at - c.first[at]
            kept, others = once(text, place, digests)
            taken.append(before + text[kept])
            places.append(place[kept])
            halves.append(digests[kept])
            more += others
        order, both = pa.array(np.concatenate(taken)), np.concatenate(halves)
        spots = {"place": np.concatenate(places), "more": more, "high": both[:, 0], "low": both[:, 1]}
        return {"id": batch.column("id").take(order), "th": batch.column("th").take(order), **spots}

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, compare, f"id {kind}, th bigint, place int, more array<int>, high bigint, low bigint")


def once(text: np.ndarray, place: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, list[list[int] | None]]:
    """Which stretches come first among the equal ones of their text, and for each of these the places of the others."""
    # most texts repeat nothing: one sort of one number tells
    mark = np.sort(digests[:, 1] ^ (text.astype(np.uint64) * _ODD).view(np.int64))
    if not (mark[1:] == mark[:-1]).any():
        return np.arange(len(text)), [None] * len(text)
    order = np.lexsort((place, digests[:, 1], digests[:, 0], text))
    sorted_by = np.column_stack([text, digests])[order]
    first = np.concatenate([[True], (sorted_by[1:] != sorted_by[:-1]).any(axis=1)])
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(order))
    others = {int(order[a]): place[order[a + 1 : b]].tolist() for a, b in zip(starts, ends, strict=True) if b - a > 1}
    kept = np.sort(order[starts])
    return kept, [others.get(k) for k in kept.tolist()]


def repeats(rows: DataFrame, min_words: int) -> DataFrame:
    """``id``, ``th`` and ``places``: the words at which a stretch starts that a document with a smaller id holds.

    ``rows`` have the digests of their shared runs, the hot ones apart (``chunks`` and ``hot``).
    """
    found = stretches(rows.where(F.size("chunks") > 0).drop("hot"), min_words)
    # the rows of a digest are at most those of a run that is not hot; the smallest id is known from the first of them on
    upwards = Window.partitionBy("high", "low").orderBy(F.col("id").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    later = after_first(found.withColumn("first", F.first("id").over(upwards)))
    hot = rows.where(F.size("hot") > 0).select("id", "th", "text", F.col("hot").alias("chunks"))
    if not hot.isEmpty():
        found = stretches(hot, min_words)
        first = found.groupBy("high", "low").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        later = later.unionByName(after_first(joined(found, first.where("n > 1 AND first IS NOT NULL"), ["high", "low"])))
    return later.groupBy("id", "th").agg(F.collect_list("place").alias("places"))


def after_first(found: DataFrame) -> DataFrame:
    """``id``, ``th`` and every ``place`` of the rows whose id comes after that of their digest's ``first``."""
    after = (F.col("id") > F.col("first")) | (F.col("id").isNull() & F.col("first").isNotNull())
    places = F.concat(F.array("place"), F.coalesce("more", F.array().cast("array<int>")))
    return found.where(after).select("id", "th", F.explode(places).alias("place"))


def spans(text: str, places: list[int], min_words: int) -> list[tuple[int, int]]:
    """The stretches at ``places`` as pairs of characters, those that touch or overlap as one."""
    starts, ends = words(text)
    runs: list[list[int]] = []
    for place in sorted(places):
        if runs and place <= runs[-1][1]:
            runs[-1][1] = place + min_words
        else:
            runs.append([place, place + min_words])
    return [(int(starts[a]), int(ends[b - 1])) for a, b in runs]


def dedup_substrings(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with repeated passages taken out of the text, and ``removed``: their places as pairs of characters."""
    given = docs.drop("removed")
    names = given.columns
    text = whole_text(text_col)
    keys = [F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text")]
    rows = given.withColumn("_th", F.xxhash64(text))

    def beside(left: DataFrame, found: DataFrame, *values: str) -> DataFrame:
        right = found.select(F.col("id").alias("_rid"), F.col("th").alias("_rth"), *[F.col(v).alias(f"_{v}") for v in values])
        return left.join(right, F.col(id_col).eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")), "left").drop("_rid", "_rth")

    # read twice: the texts that share something with others are compared, the others are done
    # as a written table numbers its rows for good, the number takes the place of the hash
    marked = beside(rows, shared_chunks(given.select(*keys), min_words), "chunks", "hot").withColumn("_th", F.monotonically_increasing_id())
    marked = materialized(marked, "marked")
    some = marked.where(F.col("_chunks").isNotNull())
    shared = [F.col(f"_{c}").alias(c) for c in ("chunks", "hot")]
    found = repeats(some.select(F.col(id_col).alias("id"), F.col("_th").alias("th"), text.alias("text"), *shared), min_words)
    placed = beside(some, found, "places")
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    kind = T.StructType([*given.schema.fields, T.StructField("removed", span)])
    none = F.array().cast(span).alias("removed")

    def cut(batch: pa.RecordBatch) -> dict:
        texts, places = batch.column(text_col).to_pylist(), batch.column("_places").to_pylist()
        out = {c: batch.column(c) for c in names}
        gone, left = [], []
        for text, at_words in zip(texts, places, strict=True):
            cut_out = spans(text, at_words, min_words)
            at, kept = 0, []
            for start, end in cut_out:
                kept.append(text[at:start])
                at = end
            left.append("".join(kept) + text[at:])
            gone.append([{"start": a, "end": b} for a, b in cut_out])
        return out | {text_col: left, "removed": gone}

    whole = marked.where(F.col("_chunks").isNull()).select(*names, none)
    unique = placed.where(F.col("_places").isNull()).select(*names, none)
    return whole.unionByName(unique).unionByName(map_batches(placed.where(F.col("_places").isNotNull()).select(*names, "_places"), cut, kind))
