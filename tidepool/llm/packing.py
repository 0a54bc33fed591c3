"""Packing documents into sequences of a fixed length by length patterns.

1. Lengths are counted over the whole corpus: a histogram of at most ``capacity`` numbers.
2. Lengths are rounded up to bins. All patterns of up to three bins that fill a sequence are listed,
   and non-negative least squares fits how often each is used to the histogram of bins.
3. The fitted counts are rounded and filled with exact lengths, as far as there are documents; the last
   length of a pattern is the one that fills the sequence. What is left is placed by best fit, longest first: into the smallest gap that holds it, else into a new
   sequence. Equal lengths are placed together, so the work depends on ``capacity``, not on documents.
   Patterns may use up lengths that best fit needs, so smaller shares of the fitted counts are tried too, and
   the plan with the fewest sequences stays: never more than best fit makes alone.
4. The plan says which ranks of each length go where. A document's rank among those of its length is its
   rank in its task plus the number of such documents in earlier tasks, so no length meets in one task.

The plan has a row for each length of each kind of sequence. Every step of the filling uses up a
length or a kind, so there are some thousands of rows whatever the corpus; that is what is broadcast.

Null texts count as empty and hold the end id alone. Repeated rows and ids are placed one by one. Rows
with a null length stay and have no place. Other columns of documents are not carried. An empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidepool.llm.common import map_batches, small_batches, whole_text
from tidepool.llm.encoders import encoder
from tidepool.session import materialized

#: Bins of the histogram for the fit.
BINS = 256
#: Shares of the fitted counts that are tried, none last; the first with the fewest sequences is the plan.
SHARES = (1.0, 0.75, 0.5, 0.25, 0.125, 0.0)


def patterns(bins: int) -> np.ndarray:
    """Every way to fill ``bins`` with two or three bins, as counts per bin (row 0: bin 1)."""
    a, b = np.meshgrid(np.arange(bins), np.arange(1, bins), indexing="ij")
    c = bins - a - b
    keep = (a <= b) & (b <= c)
    out = np.zeros((bins + 1, int(keep.sum())))
    for x in (a, b, c):
        np.add.at(out, (x[keep], np.arange(out.shape[1])), 1)
    return out[1:]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Non-negative least squares by active sets: ``x >= 0`` with the least ``|ax - b|``."""
    x = np.zeros(a.shape[1])
    used: list[int] = []
    scale = max(float(np.abs(b).max(initial=0)), 1.0)
    for _ in range(rounds or 4 * len(b)):
        gain = a.T @ (b - a @ x)
        gain[used] = 0
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9 * scale:
            break
        used.append(best)
        while True:
            s = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            low = s <= 1e-12 * scale
            if not low.any():
                break
            now = x[used]
            step = min(float(np.min(now[low] / (now[low] - s[low] + 1e-300))), 1.0)
            now = now + step * (s - now)
            x[used] = np.maximum(now, 0)
            used = [u for u, v, l in zip(used, now, low, strict=True) if not (l and v <= 1e-12 * scale)]
            gone = np.ones(len(x), bool)
            gone[used] = False
            x[gone] = 0
            if not used:
                break
        if used:
            x[used] = s
        if best not in used:
            break  # the newcomer gains nothing within rounding
    return x


class Filling:
    """Kinds of sequences: how many there are, their lengths as (length, times) and the gap left."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.capacity = capacity
        self.gaps: dict[int, list[tuple[tuple, int]]] = {}
        self.open = np.zeros(capacity + 1, bool)

    def put(self, content: tuple, times: int) -> None:
        if times:
            gap = self.capacity - sum(length * m for length, m in content)
            self.gaps.setdefault(gap, []).append((content, times))
            self.open[gap] = True

    @property
    def sequences(self) -> int:
        return sum(times for kinds in self.gaps.values() for _, times in kinds)

    def use(self, bins: list[int], times: int, width: int) -> None:
        """Fill a pattern of bins, longest first: the longest of each bin, and last what fills the gap exactly."""
        *others, last = sorted(bins, reverse=True)
        while times > 0:
            chosen: Counter[int] = Counter()
            gap = self.capacity
            for b, most in [*((b, b * width) for b in others), (last, self.capacity)]:
                low, high = (b - 1) * width, min(most, gap)
                free = [length for length in range(high, low, -1) if self.left[length] > chosen[length]][:1]
                if not free:
                    return
                chosen[free[0]] += 1
                gap -= free[0]
            if gap:
                return
            n = min([times, *(int(self.left[length]) // m for length, m in chosen.items())])
            for length, m in chosen.items():
                self.left[length] -= n * m
            self.put(tuple(chosen.items()), n)
            times -= n

    def best_fit(self, length: int) -> None:
        n = int(self.left[length])
        self.left[length] = 0
        while n:
            fitting = np.flatnonzero(self.open[length:])
            if len(fitting):
                gap = length + int(fitting[0])
                content, there = self.gaps[gap].pop()
                self.open[gap] = bool(self.gaps[gap])
            else:
                gap, content, there = self.capacity, (), n
            most = gap // length
            full = min(there, n // most)
            self.put((*content, (length, most)), full)
            n -= full * most
            if full < there and n:
                self.put((*content, (length, n)), 1)
                full, n = full + 1, 0
            if content:
                self.put(content, there - full)


def plan(counts: dict[int, int], capacity: int, bins: int = BINS) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, rank after the last, first sequence, sequences, offset)."""
    width = -(-capacity // min(bins, capacity))
    bins = -(-capacity // width)
    binned = np.zeros(bins)
    for length, n in counts.items():
        if length < capacity:
            binned[-(-length // width) - 1] += n
    forms = patterns(bins)
    # a pattern of two or three bins, used as often as all documents of a bin allow
    fitted = nnls(forms, binned / max(binned.sum(), 1)) * binned.sum()
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    filling = None
    for share in SHARES:
        tried = Filling(counts, capacity)
        for k in np.argsort(-fitted, kind="stable"):
            if (times := int(np.rint(share * fitted[k]))) < 1:
                break
            tried.use([int(b) + 1 for b in np.flatnonzero(forms[:, k]) for _ in range(int(forms[b, k]))], times, width)
        for length in range(capacity, 0, -1):
            tried.best_fit(length)
        if filling is None or tried.sequences < filling.sequences:
            filling = tried
        if filling.sequences == least:
            break

    rows, rank, sequence = [], Counter(), 0
    for gap in sorted(filling.gaps):
        for content, times in filling.gaps[gap]:
            offset = 0
            for length, m in content:
                rows.append((length, rank[length], rank[length] + m * times, sequence, times, offset))
                rank[length] += m * times
                offset += length * m
            sequence += times
    return rows


def place(pieces: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; columns of these names are replaced.

    Lengths are between 1 and ``capacity``; a null length has no place, any other is an error.
    """
    spark = pieces.sparkSession
    given = pieces.drop("sequence_id", "offset")
    small_batches(spark)
    kind = T.StructType([*given.schema.fields, T.StructField("_task", T.LongType()), T.StructField("_rank", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            ranks = []
            for length in batch.column(length_col).to_pylist():
                if length is not None and not 0 < length <= capacity:
                    raise ValueError(f"a length of {length}, beyond 1 to {capacity}")
                ranks.append(seen[length])
                seen[length] += 1
            yield batch.append_column("_task", pa.array([task] * len(ranks), pa.int64())).append_column("_rank", pa.array(ranks, pa.int64()))

    numbered = materialized(given.mapInArrow(number, kind), "pieces")
    length = F.col(length_col)
    tasks = numbered.where(length.isNotNull()).groupBy(length.cast("long").alias("_length"), F.col("_task").alias("_t")).agg((F.max("_rank") + 1).alias("_n"))
    earlier = W.partitionBy("_length").orderBy("_t").rowsBetween(W.unboundedPreceding, -1)
    tasks = materialized(tasks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("long"))), "lengths")
    counts = {r[0]: r[1] for r in tasks.groupBy("_length").agg(F.sum("_n")).collect()}  # at most ``capacity`` rows
    slots = spark.createDataFrame(plan(counts, capacity), "_len bigint, _first bigint, _after bigint, _sequence bigint, _times bigint, _offset bigint")
    ranked = numbered.join(tasks.drop("_n").hint("merge"), (length == F.col("_length")) & (F.col("_task") == F.col("_t")), "left")
    rank = F.col("_before") + F.col("_rank")
    placed = ranked.join(F.broadcast(slots), (F.col("_length") == F.col("_len")) & (rank >= F.col("_first")) & (rank < F.col("_after")), "left")
    since = rank - F.col("_first")
    return placed.select(
        *given.columns,
        (F.col("_sequence") + since % F.col("_times")).alias("sequence_id"),
        (F.col("_offset") + length * F.floor(since / F.col("_times"))).cast("long").alias("offset"),
    )


def cut_pieces(docs: DataFrame, path: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every document and its end id, cut into pieces of ``capacity``; only the first may be shorter."""
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))

    def cut(batch: pa.RecordBatch) -> dict:
        ids, sizes = encoder(path).encode(batch.column("text"))
        ids = memoryview(np.insert(ids, np.cumsum(sizes), end_id).astype("<u4"))
        sizes = sizes + 1
        n = -(-sizes // capacity)
        piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rest = np.repeat(sizes - (n - 1) * capacity, n)
        start = np.where(piece == 0, 0, rest + (piece - 1) * capacity)
        length = np.where(piece == 0, rest, capacity)
        at = np.repeat(np.cumsum(sizes) - sizes, n) + start
        crcs = [zlib.crc32(ids[i : i + k]) for i, k in zip(at.tolist(), length.tolist(), strict=True)]
        return {"doc_id": batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(n)), n))), "piece": piece, "start": start, "length": length, "ids_crc32": crcs}

    return map_batches(given, cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack_documents(docs: DataFrame, path: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    return place(cut_pieces(docs, path, end_id, capacity, id_col, text_col), capacity)
