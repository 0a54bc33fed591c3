"""SimHash near-duplicates: fingerprints, links at a few differing bits, connected groups.

A distance table holds each fingerprint's Hamming distances to fixed reference fingerprints
(pivots). By the triangle inequality two fingerprints at distance k differ by at most k in every
column, so a pair with a larger difference is discarded unseen, and what is left is verified bit by bit.

Distances of unrelated fingerprints lie close around 32, so the table alone would have to compare
most pairs. The pairs to compare are therefore drawn from blocks: of k + 2 blocks of bits at least
two are equal at k differing bits. A bucket is split further by the cell of the first pivot's distance,
with the rows near a border in both cells. Links are found between distinct fingerprints; each has
at most a few thousand others within two bits, so no group of copies makes more.

Null and empty texts have fingerprint zero and are linked like any other. Rows with a null id get a
fingerprint and a group, but a null id never names a group unless there is no other (then it is null).
Repeated rows stay. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import map_batches, whole_text
from tidepool.session import materialized

SEED = 42
PIVOTS = [xxhash.xxh64_intdigest(f"pivot {k}", SEED) for k in range(16)]
#: Width of a cell of the first pivot's distance.
CELL = 8
_BLOCK = 1 << 16


def fingerprint(text: str, words: int = 3) -> int:
    """Bit i is set if it is set in over half the hashes of the text's shingles."""
    parts = text.encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not parts:
        return 0
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    joined = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    firsts, lasts = starts[:n].tolist(), (starts + sizes)[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(firsts, lasts, strict=True)], "<u8")
    set_in = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        bits = np.unpackbits(hashes[at : at + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``th`` (hash of the text) and ``fp``, the fingerprint as a signed 64-bit number."""
    kind = docs.schema[id_col].dataType.simpleString()
    text = whole_text(text_col)
    given = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))

    def make(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
        return {"doc_id": batch.column("doc_id"), "th": batch.column("th"), "fp": found.view(np.int64)}

    return map_batches(given, make, f"doc_id {kind}, th bigint, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def distance_table(fp: Column) -> Column:
    """Distances to the pivots."""
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))).cast("tinyint") for p in PIVOTS])


def _buckets(fp: Column, bits: int) -> Column:
    """A key for each pair of blocks: its number and the bits of both."""
    n = bits + 2
    edges = [64 * k // n for k in range(n + 1)]
    blocks = [F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges, edges[1:], strict=False)]
    return F.array(*[F.struct(F.lit(k).alias("pair"), blocks[i].alias("one"), blocks[j].alias("two")) for k, (i, j) in enumerate(combinations(range(n), 2))])


def links(fps: DataFrame, bits: int) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints in column ``fp`` that differ in at most ``bits`` bits."""
    fp = F.col("fp")
    keyed = fps.select(fp, distance_table(fp).alias("table"), F.explode(_buckets(fp, bits)).alias("bucket"))
    near = F.col("table")[0].cast("int")
    cells = F.sequence(F.floor((near - bits) / CELL), F.floor((near + bits) / CELL))
    left = keyed.select(F.col("fp").alias("a"), F.col("table").alias("ta"), "bucket.*", F.explode(cells).alias("cell"))
    right = keyed.select(F.col("fp").alias("b"), F.col("table").alias("tb"), "bucket.*", F.floor(near / CELL).alias("cell")).alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("pair", "one", "two", "cell")]
    close = F.forall(F.zip_with("ta", "tb", lambda x, y: F.abs(x - y) <= bits), lambda ok: ok)
    verified = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    found = left.alias("l").join(right, [*same, F.col("a") < F.col("b"), close, verified])
    return found.select("a", "b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``node`` and ``label`` for every node of ``pairs`` (a, b): the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    long chains shorten by doubling. Rounds are tables in the shared folder.
    """
    both = materialized(pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a"))).toDF("node", "other"), "links")
    labels = materialized(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        theirs = labels.toDF("other", "theirs")
        least = both.join(theirs, "other").groupBy("node").agg(F.min("theirs").alias("least"))
        step = labels.join(least, "node").select("node", F.col("label").alias("old"), F.least("label", "least").alias("mid"))
        jump = step.join(labels.toDF("mid", "far"), "mid").select("node", F.least("mid", "far").alias("label"), (F.least("mid", "far") < F.col("old")).alias("moved"))
        done = materialized(jump, "labels")
        labels = done.drop("moved")
        if done.where("moved").isEmpty():
            return labels


def _groups(marked: DataFrame, bits: int) -> DataFrame:
    """``fp``, ``label`` of its group and ``component_id`` for every fingerprint of ``marked`` (doc_id, fp)."""
    fps = materialized(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    labels = components(links(fps.select("fp"), bits)).toDF("node", "label")
    grouped = fps.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    named = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    return grouped.select("fp", "label").join(named, "label").select("fp", "label", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id of the group, for every row."""
    marked = materialized(fingerprints(docs, words, id_col, text_col).select("doc_id", "fp"), "fingerprints")
    groups = _groups(marked, bits).select("fp", "component_id")
    return marked.join(groups, "fp").select(F.col("doc_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 3, bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group with all its columns: the smallest id, null last, then the smallest hash of the text.

    Of rows equal in id and text any one stays.
    """
    marked = materialized(fingerprints(docs, words, id_col, text_col), "fingerprints")
    labelled = marked.join(_groups(marked.select("doc_id", "fp"), bits).select("fp", "label"), "fp")
    first = F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("id"), "th")
    chosen = labelled.groupBy("label").agg(F.min(first).alias("k")).select(F.col("k.id").alias("_kid"), F.col("k.th").alias("_kth"))
    rows = docs.withColumn("_th", F.xxhash64(whole_text(text_col)))
    kept = rows.join(chosen, F.col(id_col).eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")), "left_semi")
    return kept.dropDuplicates([id_col, "_th"]).select(*docs.columns)
