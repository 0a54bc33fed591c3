"""A trie of conversations by turns, built as burst tries over Spark partitions.

A turn's id is a 128-bit digest of its role and text; a conversation is the string of its turn ids. Equal conversations are
merged into one class first, with their number, least id and the digest of their ids. A container holds the classes that
share a trie head, a prefix of turns; at first that is the root. A container of more than ``container`` classes bursts:
each next turn id makes a head with a container of its own, until all are small. Partitions (shards) then hold whole
containers, sorted, and sweep each in one pass with the path of open nodes in hand: a node is closed once the next
class leaves it. Heads that burst are summed from their children, deepest first.

How it stays bounded: turns are numbered inside range partitions, where one conversation may lie in many, and only
conversations that cross a border need an offset, fewer than there are partitions. A row holds at most ``segment``
turns; a longer conversation goes on in a trie of its own under the class that it shared, and alone it needs no trie.
Copies of a conversation are merged on the map side. Digests of ends are streamed over sorted blocks of ids, as SHA-256
knows only one order; a block row stands for up to 4096 ids.

Results: one row per distinct sequence of first turns, the root included if there is any conversation. Turns without a
conversation id belong to none and are left out. A null turn number is first; turns of one number are ordered by the
digest of role and text, so repeated rows are repeated turns. Null roles and texts are empty. Remainders of negative ids
are negative, as in SQL. A conversation without turns of its own left still is a member, of the root at least. Very long texts
pass once, to be digested and counted. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidepool.llm.common import small_batches, whole_text
from tidepool.session import materialized

ID_BYTES = 16
#: Turns in one row, classes in a container, as bits the ids of a block of ends.
SEGMENT, CONTAINER, BLOCK_BITS = 4096, 5_000, 12
OUT_ROWS = 10_000
WORDS = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Conversations in a family, and the modulus of the number of turns taken from its first.
FAMILY, SHARED = 20, 4

CLASS = "head binary, seq binary, words array<int>, head_conv bigint, n_convs bigint, n_ends bigint, first bigint, ends string"
NODE = "head binary, prefix binary, cut int, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _stream(df: DataFrame, rows: object, schema: str) -> DataFrame:
    """``rows`` turns an iterator of a partition's rows into an iterator of tuples."""
    small_batches(df.sparkSession)
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in rows(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            held.append(row)
            if len(held) == OUT_ROWS:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    return df.mapInArrow(run, kind)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` from 0 in order of turns, ``tid`` and ``n_words`` of every turn."""
    role, text = whole_text("role"), whole_text("text")
    tid = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    given = turns.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", tid.alias("tid"), F.regexp_count(text, F.lit(WORDS)).alias("n_words"))
    order = ("conv_id", "turn", "tid")
    laid = given.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "tid", "n_words", F.spark_partition_id().alias("part"))

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        conv, n = None, 0
        for conv_id, tid_, words, part in rows:
            conv, n = conv_id, (n + 1 if conv_id == conv else 0)
            yield conv_id, tid_, words, part, n

    rows = materialized(_stream(laid, count, "conv_id bigint, tid binary, n_words int, part int, n bigint"), "turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "part").agg(F.count("*").alias("size")).withColumn("offset", F.sum("size").over(earlier))
    # a partition begins inside at most one conversation, so there are fewer offsets than partitions
    offsets = sizes.where("offset > 0").select("conv_id", "part", "offset")
    pos = F.col("n") + F.coalesce("offset", F.lit(0))
    return rows.join(F.broadcast(offsets), ["conv_id", "part"], "left").select("conv_id", pos.alias("pos"), "tid", "n_words")


def rebuilt_segments(turns: DataFrame, segment: int) -> DataFrame:
    """``conv_id``, ``n`` turns, ``seg`` and its ``seq`` and ``words``, of every conversation with its family's first turns."""
    own = numbered_turns(turns)
    of_family = F.col("conv_id") - F.col("conv_id") % FAMILY
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    heads = own.where((F.col("conv_id") == of_family) & (F.col("pos") < SHARED - 1)).select(F.col("conv_id").alias("base"), F.col("pos").alias("at"), "tid", "n_words")
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n_own")).select("conv_id", "n_own", of_family.alias("base"), h.alias("h"))
    convs = convs.join(heads.groupBy("base").agg(F.count("*").alias("n_base")), "base", "left")
    shared = F.least("h", F.coalesce("n_base", F.lit(0)))
    n = shared + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
    convs = materialized(convs.select("conv_id", "base", "h", shared.alias("shared"), n.alias("n")), "conversations")

    kept = own.join(convs, "conv_id").where("pos >= h").select("conv_id", "n", (F.col("pos") - F.col("h") + F.col("shared")).alias("at"), "tid", "n_words")
    taken = convs.where("shared > 0").join(heads, "base").where("at < h").select("conv_id", "n", "at", "tid", "n_words")
    listed = F.sort_array(F.collect_list(F.struct("at", "tid", "n_words")))
    rows = kept.unionByName(taken).groupBy("conv_id", "n", F.expr(f"at div {segment}").cast("int").alias("seg")).agg(listed.alias("t"))
    seq = F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["tid"])), ""))
    rows = rows.select("conv_id", "n", "seg", seq.alias("seq"), F.transform("t", lambda x: x["n_words"]).alias("words"))
    bare = convs.where("n = 0").select("conv_id", "n", F.lit(0).alias("seg"), F.unhex(F.lit("")).alias("seq"), F.array().cast("array<int>").alias("words"))
    return rows.unionByName(bare)


def classes_of(rows: DataFrame, last: Column) -> DataFrame:
    """Equal sequences under a head as one row each; ``last`` tells the members that end there."""
    end = F.when(last, F.col("conv_id"))
    blocks = rows.groupBy("head", "seq", "words", "head_conv", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.count("*").alias("n_convs"), F.count(end).alias("n_ends"), F.min("conv_id").alias("first"), F.array_join(F.sort_array(F.collect_list(end)), ",").alias("ends")
    )
    order = ("head", "seq", "block")
    laid = blocks.repartition("head", "seq").sortWithinPartitions(*order).select("head", "seq", "words", "head_conv", "n_convs", "n_ends", "first", "ends")

    def merge(rows_: Iterator[tuple]) -> Iterator[tuple]:
        key = None
        for head, seq, words, head_conv, n, n_ends, first, ends in rows_:
            if key is None or (head, seq) != key[:2]:
                if key is not None:
                    yield *key, *sums, digest.hexdigest()
                key, sums, digest = (head, seq, words, head_conv), [0, 0, first], hashlib.sha256()
            if n_ends:
                digest.update((("," if sums[1] else "") + ends).encode())
            sums = [sums[0] + n, sums[1] + n_ends, min(sums[2], first)]
        if key is not None:
            yield *key, *sums, digest.hexdigest()

    return _stream(laid, merge, CLASS)


def burst(classes: DataFrame, container: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Containers, heads that burst, classes that end at such a head, and the number of levels that burst."""
    open_, cut = classes, 0
    parts, heads, ended = [], [], []
    while True:
        prefix = F.expr(f"substring(seq, 1, {ID_BYTES * cut})")
        last_words = F.max(F.try_element_at("words", F.lit(cut))) if cut else F.lit(0)
        sizes = open_.groupBy("head", prefix.alias("prefix")).agg(
            F.count("*").alias("size"), F.sum("n_convs").alias("n_convs"), F.least(F.min("first"), F.min("head_conv")).alias("first"), last_words.alias("word")
        )
        big = materialized(sizes.where(F.col("size") > container).withColumn("cut", F.lit(cut)), "heads")
        placed = open_.withColumn("prefix", prefix).withColumn("cut", F.lit(cut))
        if big.isEmpty():
            parts.append(placed)
            break
        marked = materialized(placed.join(big.select("head", "prefix", F.lit(True).alias("bursts")), ["head", "prefix"], "left"), "containers")
        parts.append(marked.where("bursts is null").drop("bursts"))
        at_head = F.octet_length("seq") == ID_BYTES * cut
        ended.append(marked.where(F.col("bursts") & at_head).drop("bursts"))
        heads.append(big)
        open_, cut = marked.where(F.col("bursts") & ~at_head).drop("bursts", "prefix", "cut"), cut + 1
    none = parts[0].where("false")
    no_heads = big.where("false")
    return _union(parts), _union(heads) if heads else no_heads, _union(ended) if ended else none, cut


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


class _Node:
    __slots__ = ("children", "ends", "first", "kids", "leaves", "n", "saved", "word")

    def __init__(self, word: int, first: int | None = None):
        self.word, self.first, self.n, self.children, self.leaves, self.saved, self.ends, self.kids = word, first, 0, 0, 0, 0, NO_ENDS, []

    def close(self) -> tuple:
        """Its figures, without those of its place."""
        self.saved += (self.n - 1) * self.word
        self.leaves = self.leaves if self.children else 1
        return self.n, self.children, self.leaves, self.saved, self.ends

    def least(self, conv: int) -> None:
        self.first = conv if self.first is None else min(self.first, conv)


def sweep(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The nodes of sorted containers; the path of open nodes and their closed children are all that is held."""
    key, path, seq = None, [], b""

    def close(down_to: int) -> Iterator[tuple]:
        while len(path) > down_to:
            node = path.pop()
            figures, depth = node.close(), key[2] + len(path)
            for kid_depth, conv, kid in node.kids:
                yield None, None, None, kid_depth, conv, node.first, *kid
            if path:
                up = path[-1]
                up.least(node.first)
                up.n, up.children = up.n + node.n, up.children + 1
                up.leaves, up.saved = up.leaves + node.leaves, up.saved + node.saved
                up.kids.append((depth, node.first, figures))
            else:
                yield *key, depth, node.first, None, *figures

    for head, prefix, cut, now, words, head_conv, n, first, ends, tail_children, tail_leaves, tail_saved in rows:
        if key != (head, prefix, cut):
            yield from close(0)
            key, seq = (head, prefix, cut), prefix
            path.append(_Node(words[cut - 1] if cut else 0, head_conv if not cut else None))
        most = min(len(seq), len(now))
        same = ID_BYTES * cut
        while same < most and seq[same : same + ID_BYTES] == now[same : same + ID_BYTES]:
            same += ID_BYTES
        yield from close(same // ID_BYTES - cut + 1)
        path.extend(map(_Node, words[cut + len(path) - 1 :]))
        end = path[-1]
        end.least(first)
        end.n, end.ends = end.n + n, ends
        end.children, end.leaves, end.saved = end.children + tail_children, end.leaves + tail_leaves, end.saved + tail_saved
        seq = now
    yield from close(0)


def nodes_of(classes: DataFrame, container: int) -> DataFrame:
    """Nodes of one segment, depths within it; ``head`` is kept for those at depth 0."""
    containers, heads, ended, levels = burst(classes, container)
    given = ("head", "prefix", "cut", "seq", "words", "head_conv", "n_convs", "first", "ends", "tail_children", "tail_leaves", "tail_saved")
    laid = containers.repartition("head", "prefix", "cut").sortWithinPartitions("head", "prefix", "cut", "seq").select(*given)
    swept = materialized(_stream(laid, sweep, NODE), "nodes")
    done = [swept.where("prefix is null").select("head", *RESULT)]
    tops = swept.where("prefix is not null").drop("parent_conv_id")
    for level in range(levels - 1, -1, -1):
        # the children of the heads that burst here are the containers and heads one turn below
        below = tops.where(F.col("cut") == level + 1).withColumn("up", F.expr(f"substring(prefix, 1, {ID_BYTES * level})"))
        here = heads.where(F.col("cut") == level)
        known = below.join(here.select("head", F.col("prefix").alias("up"), F.col("first").alias("parent_conv_id")), ["head", "up"])
        done.append(known.select(F.lit(None).cast("binary").alias("head"), *RESULT))
        sums = below.groupBy("head", F.col("up").alias("prefix")).agg(F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        at_end = ended.where(F.col("cut") == level).select("head", "prefix", "ends", "tail_children", "tail_leaves", "tail_saved")
        made = here.join(sums, ["head", "prefix"]).join(at_end, ["head", "prefix"], "left").na.fill(0, ["tail_children", "tail_leaves", "tail_saved"])
        made = made.select(
            "head", "prefix", "cut", F.col("cut").cast("long").alias("depth"), F.col("first").alias("conv_id"), "n_convs",
            (F.col("kids") + F.col("tail_children")).alias("n_children"), (F.col("leaves") + F.col("tail_leaves")).alias("n_leaves"),
            (F.col("saved") + F.col("tail_saved") + (F.col("n_convs") - 1) * F.col("word")).alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
        tops = tops.where(F.col("cut") <= level).unionByName(made)
    return _union([*done, tops.where("cut = 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select("head", *RESULT)])


def conversation_trie(turns: DataFrame, segment: int = SEGMENT, container: int = CONTAINER) -> DataFrame:
    """One row per node; ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``."""
    segments = materialized(rebuilt_segments(turns, segment), "segments")
    rounds, lone = [], []
    rows = segments.where("seg = 0").withColumn("head", F.unhex(F.lit(""))).withColumn("head_conv", F.lit(None).cast("long"))
    while True:
        full = (len(rounds) + 1) * segment
        classes = materialized(classes_of(rows, F.col("n") <= full), "classes")
        rounds.append(classes)
        going = classes.where("n_convs > n_ends").select("head", "seq", F.unhex(F.md5(F.concat("head", "seq"))).alias("next"), "n_convs", "first")
        if going.isEmpty():
            break
        going = materialized(rows.where(F.col("n") > full).select("conv_id", "head", "seq").join(going, ["head", "seq"]).drop("head", "seq"), "going")
        later = segments.where(F.col("seg") >= len(rounds))
        lone.append(later.join(going.where("n_convs = 1").select("conv_id"), "conv_id").withColumn("from", F.lit(len(rounds))))
        shared = going.where("n_convs > 1").select("conv_id", F.col("next").alias("head"), F.col("first").alias("head_conv"))
        rows = later.where(F.col("seg") == len(rounds)).join(shared, "conv_id")
    return _assembled(rounds, lone, segment, container)


def _assembled(rounds: list[DataFrame], lone: list[DataFrame], segment: int, container: int) -> DataFrame:
    """Segments from the last to the first: what lies below a class is known before the class is swept."""
    key = F.unhex(F.md5(F.concat("head", "seq")))
    out, tails = [], None
    for s in range(len(rounds) - 1, -1, -1):
        classes = rounds[s].withColumn("next", key)
        alone = (F.col("n_convs") == 1) & (F.col("n_ends") == 0)
        if tails is not None:
            classes = classes.join(tails, "next", "left")
        else:
            classes = classes.select("*", *(F.lit(None).cast("long").alias(c) for c in ("children", "leaves", "saved")))
        one = F.when(alone, 1).otherwise(0)
        classes = classes.select(
            "head", "seq", "words", "head_conv", "n_convs", "first", "ends", *(F.coalesce(c, v).cast("long").alias(f"tail_{c}") for c, v in (("children", one), ("leaves", one), ("saved", F.lit(0))))
        )
        nodes = nodes_of(classes, container)
        if s:
            nodes = materialized(nodes, "segment")
            tops = nodes.where("depth = 0")
            tails = tops.select(F.col("head").alias("next"), F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
            nodes = nodes.where("depth > 0").withColumn("depth", F.col("depth") + s * segment)
        out.append(nodes.select(*RESULT))
    for rows in lone:
        turn = rows.select("conv_id", "n", (F.col("seg").cast("long") * segment).alias("before"), F.posexplode("words").alias("i", "w"))
        depth = F.col("before") + F.col("i") + 1
        at_end = depth == F.col("n")
        ends = F.when(at_end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NO_ENDS))
        one = F.lit(1).cast("long")
        out.append(
            turn.select(
                "conv_id", depth.alias("depth"), F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"), F.when(at_end, 0).otherwise(1).cast("long").alias("n_children"),
                one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), ends.alias("ends_sha256"),
            )
        )
    return _union(out)


#: The same in SQL, from the definitions; a node is the list of its turns.
ORACLE = r"""
WITH t AS (
  SELECT conv_id, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS tid,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL
), p AS (
  SELECT conv_id, tid, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid) - 1 AS pos FROM t
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
      list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
        lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM p)
), r AS (
  SELECT c.conv_id, 0 AS own, pos, tid, words FROM c JOIN p ON p.conv_id = c.base AND pos < h
  UNION ALL
  SELECT c.conv_id, 1, pos, tid, words FROM c JOIN p ON p.conv_id = c.conv_id AND pos >= h
), d AS (
  SELECT conv_id, list({'tid': tid, 'w': words} ORDER BY own, pos) AS turns FROM r GROUP BY conv_id
), s AS (
  SELECT conv_id, coalesce([x.tid FOR x IN turns], []::VARCHAR[]) AS ids, coalesce([x.w FOR x IN turns], []) AS words
  FROM c LEFT JOIN d USING (conv_id)
), m AS (
  SELECT conv_id, ids, k AS depth, ids[1:k] AS node, CASE WHEN k > 0 THEN words[k] ELSE 0 END AS w
  FROM s, unnest(range(0, len(ids) + 1)) u(k)
), n AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ids) = depth), '')) AS ends_sha256
  FROM m GROUP BY node, depth
), k AS (
  SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
), f AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node, depth)
), b AS (
  SELECT node[1:j] AS node, j AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w) AS saved_tokens
  FROM f, unnest(range(0, f.depth + 1)) u(j) GROUP BY ALL
)
SELECT f.conv_id, f.depth, CASE WHEN f.depth > 0 THEN up.conv_id END AS parent_conv_id, f.n_convs, f.n_children::BIGINT AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN b USING (node, depth) LEFT JOIN n up ON up.node = f.node[1:f.depth - 1] AND up.depth = f.depth - 1
"""
