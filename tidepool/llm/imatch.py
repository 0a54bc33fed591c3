"""I-Match fingerprints with randomised lexicons, in SQL functions alone.

Terms are runs of letters and digits, lower-cased. The lexicon holds the terms whose inverse document
frequency over all distinct texts lies in a band, so that copies of a text cannot push its terms out. A term that
occurs in a share f of the texts takes up at least f of the texts' distinct terms, so a band that ends at the share f holds at most (mean number of
distinct terms) / f terms, however large the corpus; this bounds what is sent to every task.

A document's distinct terms of the lexicon are sorted, thinned to several random sub-lexicons of
several densities, and each non-empty selection is hashed. Two fingerprints are alike by the share of
equal hashes among the selections that are not empty in both, taken at the density where it is largest.
A document whose selections are all empty, having few terms of the lexicon or none, hashes all its distinct words
instead, so that equal texts, and only such with the same words, agree.

Null texts count as empty; all empty texts agree with each other. Repeated rows stay; rows equal in
id and text are one document in the order of documents. Documents follow each other by descending id,
null ids last, equal ids by a hash of their text; after the last comes the first, so a single document
follows itself. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm.common import whole_text
from tidepool.session import materialized

#: Shares of distinct texts between which a lexicon term's document frequency lies (idf between 2.3 and 6.9).
BAND = (0.001, 0.1)
#: A sub-lexicon of density step r keeps a term if r given bits of its hash are zero.
DENSITIES = (2, 4, 6, 8, 10)
#: Random sub-lexicons of each density: each looks at other bits.
LEXICONS = 10
_SLOTS = 1 << 13


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def term_hashes(text: Column) -> Column:
    """Sorted hashes of the distinct words."""
    return F.array_sort(F.array_distinct(F.transform(words(text), lambda w: F.xxhash64(w))))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND, text_col: str = "text") -> DataFrame:
    """One row: ``slots``, an array of arrays that holds each lexicon term at its hash modulo the size."""
    text = whole_text(text_col)
    th = F.xxhash64(text)
    total = docs.agg(F.count_distinct(th).alias("n")).scalar()
    texts = docs.select(th.alias("th"), text.alias("text")).dropDuplicates(["th"])
    counts = texts.select(F.explode(F.array_distinct(words(F.col("text")))).alias("w")).groupBy(F.xxhash64("w").alias("h")).agg(F.count(F.lit(1)).alias("df"))
    kept = counts.where((F.col("df") >= F.lit(band[0]) * total) & (F.col("df") <= F.lit(band[1]) * total))
    slot = F.pmod("h", F.lit(_SLOTS)).alias("slot")
    held = kept.groupBy(slot).agg(F.collect_list("h").alias("hs"))
    every = docs.sparkSession.range(_SLOTS).withColumnRenamed("id", "slot").join(held, "slot", "left")
    filled = F.coalesce("hs", F.array().cast("array<bigint>"))
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", filled.alias("hs")))), lambda s: s["hs"]).alias("slots"))


def signatures(text: Column, slots: Column) -> Column:
    """Hashes of the selections, a null for an empty one: densities one after the other."""

    def zero(window: int, bits: int) -> Callable[[Column], Column]:
        return lambda h: F.shiftright(h, 5 * window).bitwiseAND(F.lit((1 << bits) - 1)) == 0

    def chain(terms: Column, k: int, left: tuple[int, ...]) -> Column:
        """The selections of sub-lexicon ``k``; each density thins the one before."""
        if len(left) == 1:
            return F.array(F.filter(terms, zero(k, left[0])))
        return _let(F.filter(terms, zero(k, left[0])), lambda s: F.concat(F.array(s), chain(s, k, left[1:])))

    def thinned(terms: Column) -> Column:
        rows = F.array(*[chain(terms, k, DENSITIES) for k in range(LEXICONS)])
        return _let(rows, lambda x: F.flatten(F.array(*[F.transform(x, _at(d)) for d in range(len(DENSITIES))])))

    def hashed(selection: Column) -> Column:
        return F.when(F.size(selection) > 0, F.xxhash64(selection))

    def instead(all_terms: Column) -> Column:
        seeds = F.array(*[F.lit(k) for k in range(LEXICONS * len(DENSITIES))])
        return F.transform(seeds, lambda k: F.xxhash64(k, all_terms))

    def of_terms(all_terms: Column) -> Column:
        known = F.filter(all_terms, lambda h: F.array_contains(F.get(slots, F.pmod(h, F.lit(_SLOTS)).cast("int")), h))
        some = _let(known, lambda t: F.transform(thinned(t), hashed))
        return _let(some, lambda s: F.when(F.exists(s, lambda x: x.isNotNull()), s).otherwise(instead(all_terms)))

    return _let(term_hashes(text), of_terms)


def _at(d: int) -> Callable[[Column], Column]:
    return lambda x: F.element_at(x, d + 1)


def likeness(a: Column, b: Column) -> Column:
    """Between 0 and 1; 1 for equal fingerprints."""

    def at(d: int) -> Column:
        left, right = (F.slice(x, d * LEXICONS + 1, LEXICONS) for x in (a, b))
        pairs = F.arrays_zip(left.alias("x"), right.alias("y"))
        equal = F.size(F.filter(pairs, lambda p: p["x"] == p["y"]))
        some = F.size(F.filter(pairs, lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
        return equal / F.greatest(some, F.lit(3))

    return F.when(F.forall(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda same: same), F.lit(1.0)).otherwise(F.greatest(*[at(d) for d in range(len(DENSITIES))]))


def printed(signature: Column) -> Column:
    """Eight hex digits for each selection, dashes for an empty one."""
    low = F.transform(signature, lambda s: F.coalesce(F.lpad(F.lower(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"), F.lit("--------")))
    return F.concat_ws("", low)


def neighbours(keys: DataFrame) -> DataFrame:
    """``keys`` (id, th, n) with ``next_id`` and ``next_th`` of the document that follows.

    Rows are cut into ranges of ids, ordered within each range, and the ends of the ranges are joined.
    """
    order = [F.col("id").desc_nulls_last(), F.col("th")]
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keys.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
    inside = W.partitionBy("part").orderBy(*order)
    led = ranged.withColumns({"next_id": F.lead("id").over(inside), "next_th": F.lead("th").over(inside), "rank": F.row_number().over(inside)})
    led = materialized(led, "order")
    # one row per range
    firsts = led.where("rank = 1").select("part", F.struct("id", "th").alias("first"))
    over = W.orderBy("part")
    after = firsts.select(F.col("part").alias("p"), F.coalesce(F.lead("first").over(over), F.first("first").over(over.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("after"))
    inner = led.where(F.col("next_th").isNotNull()).select("id", "th", "n", "next_id", "next_th")
    ends = led.where(F.col("next_th").isNull()).join(after, F.col("part") == F.col("p")).select("id", "th", "n", F.col("after.id").alias("next_id"), F.col("after.th").alias("next_th"))
    return inner.union(ends)


def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and how alike they are.

    The edited text has the last third of its characters replaced by as many (or all) from the start of
    the next document. ``near_next`` compares with the next document's fingerprint.
    """
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    keys = rows.select("id", "th", F.length("text").cast("long").alias("n")).distinct()
    pairs = materialized(neighbours(keys), "next")
    third = F.floor(F.col("n") / 3).cast("int")

    wanted = pairs.select(F.col("id").alias("for_id"), F.col("th").alias("for_th"), third.alias("need"), "next_id", "next_th")
    ahead = rows.join(wanted, (F.col("th") == F.col("next_th")) & F.col("id").eqNullSafe(F.col("next_id")))
    tails = ahead.select("for_id", "for_th", "need", F.expr("substring(text, 1, need)").alias("tail")).dropDuplicates(["for_id", "for_th"])
    both = rows.join(tails, (F.col("th") == F.col("for_th")) & F.col("id").eqNullSafe(F.col("for_id")))
    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, length(text) - need)"), F.col("tail"))
    spark = docs.sparkSession
    # the lexicon enters the plan as one constant; a subquery can't be read inside array functions
    name = f"tidepool_{uuid.uuid4().hex}"
    lexicon(docs, band, text_col).createOrReplaceTempView(name)
    spark.sql(f"DECLARE VARIABLE {name} ARRAY<ARRAY<BIGINT>>")
    spark.sql(f"SET VARIABLE {name} = (SELECT slots FROM {name})")
    slots = F.expr(name)
    made = both.select("id", "th", n.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), signatures(F.col("text"), slots).alias("s"), signatures(edited, slots).alias("e"))
    made = materialized(made, "signatures")
    spark.sql(f"DROP TEMPORARY VARIABLE {name}")
    spark.catalog.dropTempView(name)

    one = made.groupBy("id", "th").agg(F.first("s").alias("next_s")).withColumnsRenamed({"id": "nid", "th": "nth"})
    following = pairs.join(one, (F.col("next_th") == F.col("nth")) & F.col("next_id").eqNullSafe(F.col("nid"))).select(F.col("id").alias("pid"), F.col("th").alias("pth"), "next_s")
    joined = made.join(following, (F.col("th") == F.col("pth")) & F.col("id").eqNullSafe(F.col("pid")))
    return joined.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        printed(F.col("s")).alias("fingerprint"),
        printed(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("s"), F.col("e")).alias("near_edited"),
        likeness(F.col("s"), F.col("next_s")).alias("near_next"),
    )
