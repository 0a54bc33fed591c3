"""What each filter removes in every order of five filters: wide packed counters.

A document's five failures are a mask of five bits. What happens to a document of one mask, in all 120 orders and at
each of their five steps, is a fixed list of 600 outcomes, so it is written once into one big integer whose fields of
64 bits count removals, redundant failures, good and toxic documents lost. The integers of a part's documents are
added, which counts all 600 outcomes in one addition; a field can't run into the next before 2^64 documents. The sum
is unpacked at the end.

Documents of one part and mask have equal integers, so they are counted first, on the side of the tasks that read them,
and a part's sum takes at most 128 rows (32 masks, good or not, toxic or not), whatever its number of documents.
Repeats are found by a 128-bit digest of the text: rows are counted by (digest, part, mask, document), and a digest's
least document is told from the others by aggregates alone, so a text that very many rows hold meets in no task.

Null and empty texts are the empty text: it fails A, passes B, C and D (no share of nothing is too large) and fails E
unless its document has the smallest id. A null part is the empty string. A null id is larger than any other, so rows
without id fail E if any id has the text, and none of them does otherwise. Rows of equal id and text are counted one by
one and do not make each other repeats. Labels repeated for a document count if any of them says so; labels of no document
and null labels count for nothing. Very long texts take one batch each. An empty table gives no rows. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import map_batches, whole_text

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)
#: The counters of one step; the others follow from them.
FIELDS = ("removed", "redundant", "good_lost", "toxic_lost")
FIELD_BYTES = 8
#: The limits of the filters.
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 100, 80, 10
SYMBOLS = b"#$%&*|"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: Bytes that go on with a code point.
_INNER = bytes(range(0x80, 0xC0))
A, B, C, D, E = (1 << i for i in range(len(FILTERS)))

RESULT = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def failures(text: bytes) -> int:
    """The filters that a UTF-8 text fails by itself, as a mask; bytes are split at the contract's white space."""
    words = text.split()
    mask = A if len(words) < MIN_WORDS else 0
    if 100 * len(set(words)) < DISTINCT_PERCENT * len(words):
        mask |= B
    if 100 * (len(text) - len(text.translate(None, _UPPER))) > UPPER_PERCENT * len(text.translate(None, _INNER)):
        mask |= C
    if len(text.translate(None, SYMBOLS)) < len(text):
        mask |= D
    return mask


@cache
def packed(mask: int, good: bool, toxic: bool) -> int:
    """The integer of one document: its outcomes at all steps of all orders."""
    fields = np.zeros((STEPS, len(FIELDS)), "<u8")
    for at, order in enumerate(ORDERS):
        failing = [k for k, f in enumerate(order) if mask >> FILTERS.index(f) & 1]
        for k in failing:
            first = k == failing[0]
            fields[at * len(FILTERS) + k] = (first, not first, first and good, first and toxic)
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """The fields of a sum, a row a step."""
    size = STEPS * len(FIELDS) * FIELD_BYTES
    return np.frombuffer(total.to_bytes(size, "little"), "<u8").reshape(STEPS, len(FIELDS)).astype(np.int64)


def part_rows(part: str, masks: list[tuple[int, bool, bool, int]]) -> dict[str, list]:
    """The 600 rows of a part from its counted masks."""
    n = sum(m[3] for m in masks)
    steps = unpacked(sum(packed(mask, good, toxic) * count for mask, good, toxic, count in masks))
    removed = steps[:, 0].reshape(len(ORDERS), len(FILTERS))
    letters = np.array([[FILTERS.index(f) for f in order] for order in ORDERS]).ravel()
    alone = np.array([sum(m[3] for m in masks if m[0] == 1 << i) for i in range(len(FILTERS))])
    shapley = np.bincount(letters, steps[:, 0], len(FILTERS)) if n < 1 << 45 else None
    if shapley is None:  # beyond what a double counts one by one
        shapley = [int(steps[letters == i, 0].sum()) for i in range(len(FILTERS))]
    return {
        "part": [part] * STEPS,
        "filter_order": np.repeat(ORDERS, len(FILTERS)),
        "step": np.tile(np.arange(1, len(FILTERS) + 1), len(ORDERS)),
        "kept": (n - removed.cumsum(axis=1)).ravel(),
        "removed": steps[:, 0],
        "redundant": steps[:, 1],
        "unique_fails": alone[letters],
        "good_lost": steps[:, 2],
        "toxic_lost": steps[:, 3],
        "shapley": np.array(shapley, np.int64)[letters],
    }


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Rows counted by ``digest``, ``part``, ``doc_id`` and ``mask`` of the filters that need the text alone."""
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), whole_text(text_col).cast("binary").alias("text")
    )

    def judge(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").to_pylist()
        digests = [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
        return {"doc_id": batch.column("doc_id"), "part": batch.column("part"), "mask": [failures(t) for t in texts], "digest": digests}

    rows = map_batches(given, judge, f"doc_id {kind}, part string, mask int, digest binary")
    return rows.groupBy("digest", "part", "doc_id", "mask").agg(F.count("*").alias("n"))


def counted_masks(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents of each ``part``, ``mask`` (repeats included), ``good`` and ``toxic``."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("string").alias("key"))
    known = known.agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))))
    # rows without id have no label; their keys lie apart, so that they do not meet in one task
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.hex("digest")))
    joined = rows.withColumn("key", key).join(known, "key", "left").na.fill(False, ["good", "toxic"])
    # of each group of a digest: its rows, and the least document with that document's rows; nulls come last
    kind = ("digest", "part", "mask", "good", "toxic")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n"))
    groups = joined.groupBy(*kind).agg(F.sum("n").alias("n"), least.alias("least"))
    listed = groups.withColumn("first", F.min("least").over(Window.partitionBy("digest")))
    at_first = F.when(F.col("least.none"), F.col("n")).otherwise(F.col("least.n"))
    same = F.col("least.doc_id").eqNullSafe(F.col("first.doc_id"))
    passing = F.when(same, at_first).otherwise(F.lit(0))
    split = F.array(F.struct(passing.alias("n"), F.lit(0).alias("e")), F.struct((F.col("n") - passing).alias("n"), F.lit(E).alias("e")))
    flat = listed.select("part", "mask", "good", "toxic", F.explode(split).alias("s")).where("s.n > 0")
    return flat.groupBy("part", (F.col("mask").bitwiseOR(F.col("s.e"))).alias("mask"), "good", "toxic").agg(F.sum("s.n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step; ``labels`` has ``doc_id``, ``quality`` and ``toxic``."""
    masks = counted_masks(judged(docs, id_col, text_col, part_col), labels)

    def steps(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        got = part_rows(rows[0]["part"], [(r["mask"], r["good"], r["toxic"], r["n"]) for r in rows])
        return pa.table({name: pa.array(values) for name, values in got.items()}).cast(_arrow_schema())

    return masks.groupBy("part").applyInArrow(steps, RESULT)


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in RESULT.split(", "))])


#: The same in SQL, from the definitions.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d
), f AS (
  SELECT part, [
      len(words) < 100,
      100 * len(list_distinct(words)) < 80 * len(words),
      100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
      regexp_matches(t, '[#$%&*|]'),
      least IS NOT NULL AND (doc_id IS NULL OR doc_id > least)] AS fails,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM w
), m AS (
  SELECT part, fails, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, count(*) AS n FROM f GROUP BY ALL
), l AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || e.x || g.x AS filter_order
  FROM l a, l b, l c, l e, l g
  WHERE len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5
), s AS (
  SELECT filter_order, k AS step, substr(filter_order, k, 1) AS x, ascii(substr(filter_order, k, 1)) - 64 AS place,
    [ascii(c) - 64 FOR c IN string_split(substr(filter_order, 1, k - 1), '')] AS before
  FROM o, range(1, 6) r(k)
), r AS (
  SELECT part, filter_order, step, x, n, good, toxic, fails[place] AS failing,
    len([i FOR i IN before IF i > 0 AND fails[i]]) > 0 AS gone, len([v FOR v IN fails IF v]) AS n_fails
  FROM m, s
), g AS (
  SELECT part, filter_order, step, x,
    sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failing AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND failing AND good THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND failing AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM g
"""
