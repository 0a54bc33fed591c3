"""Scanning every version of every document for secrets with a ledger of what was scanned.

A text is addressed by its SHA-256. The ledger is a table with a row for each scan of a text: its
address, the rules applied (name and version) and what they found. A run looks up which texts lack
which rules, scans only those, appends to the ledger and joins the findings to all rows that hold the
text, whenever and under whatever id they came. A rule that gets a new version is run again alone.

Null texts count as empty. Repeated rows stay, a text is scanned once however often it occurs (rows
equal in id and text may be scanned together). Other columns are carried, but for those named as the
result's, which are replaced. Very long texts are scanned and redacted whole, in time that grows with their
length and number of findings. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidepool.llm.common import map_batches, whole_text
from tidepool.session import new_folder

_HEX = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))


@dataclass(frozen=True)
class Rule:
    """``least``: characters that ``group`` must have. ``hints``: a lower-cased text without any of them has no match."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# Patterns and least lengths of the three base rules.
BASE_RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)
# A private key to the END line of its kind; if there is none before the next BEGIN, over the header fields and base64 lines that follow.
_EOL = r"(?:[\x20\t]*(?:\\r|\r)?(?:\\n|\n))"
_PRIVATE = (
    r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1PRIVATE KEY-----"
    rf"|(?:{_EOL}+[A-Za-z-]+:\x20[^\r\n\\]*)*(?:{_EOL}+[A-Za-z0-9+/]{{40,}}={{0,2}})*(?:{_EOL}[A-Za-z0-9+/]+={{0,2}}(?=[\x20\t]*(?:[\r\n\\\"']|\Z)))?)"
)
# Public formats of further credentials.
RULES = (
    *BASE_RULES,
    Rule("private", 2, _PRIVATE, hints=("private key-----",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]+", 0, 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]+", 0, 15, ("xox",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", hints=("eyj",)),
)


def scanner(rules: tuple[Rule, ...]) -> Callable[[str, set[str]], list[tuple[str, int, int]]]:
    """A function from a text and the wanted rule keys to (name, start, end), by start and then by rule."""
    compiled = [(r, re.compile(r.pattern, re.ASCII)) for r in rules]

    def scan(text: str, wanted: set[str]) -> list[tuple[str, int, int]]:
        low = text.lower()
        found = []
        for order, (rule, pattern) in enumerate(compiled):
            if rule.key not in wanted or rule.hints and not any(h in low for h in rule.hints):
                continue
            if rule.name == "hex" and b"h" * rule.least not in text.encode().translate(_HEX):
                continue
            for m in pattern.finditer(text):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found.append((m.start(), order, m.end()))
        return [(rules[order].name, start, end) for start, order, end in sorted(found)]

    return scan


def read_ledger(spark, ledger: str) -> DataFrame:
    schema = "blob string, rules array<string>, spans array<struct<name: string, start: int, end: int>>"
    try:
        return spark.read.schema(schema).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # the first run


def update_ledger(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Scan what the ledger lacks: pairs of a text and a rule's version."""
    spark = docs.sparkSession
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("blob"), text.alias("text"))
    seen = read_ledger(spark, ledger).select(F.col("blob").alias("known"), F.explode("rules").alias("rule"))
    seen = seen.groupBy("known").agg(F.collect_set("rule").alias("done"))
    keys = F.array(*[F.lit(r.key) for r in rules])
    blobs = rows.groupBy("blob").agg(F.min("doc_id").alias("at"))
    lacking = F.array_except(keys, F.coalesce("done", F.array().cast("array<string>")))
    todo = blobs.join(seen, F.col("blob") == F.col("known"), "left").select(F.col("blob").alias("b"), "at", lacking.alias("rules")).where(F.size("rules") > 0)
    texts = rows.join(todo, (F.col("blob") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("at"))).select("blob", "rules", "text")
    scan = scanner(rules)

    def work(batch: pa.RecordBatch) -> dict:
        wanted = batch.column("rules").to_pylist()
        found = [scan(t, set(w)) for t, w in zip(batch.column("text").to_pylist(), wanted, strict=True)]
        return {"blob": batch.column("blob"), "rules": wanted, "spans": [[dict(zip(("name", "start", "end"), x, strict=True)) for x in f] for f in found]}

    scanned = map_batches(texts, work, "blob string, rules array<string>, spans array<struct<name: string, start: int, end: int>>")
    scanned.write.mode("append").parquet(ledger)


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with ``found``: spans of the current rules as (start, order, end, name), in order."""
    names = {r.name: k for k, r in enumerate(rules)}
    order = F.element_at(F.create_map(*[x for n, k in names.items() for x in (F.lit(n), F.lit(k))]), F.col("s.name"))
    log = read_ledger(docs.sparkSession, ledger).where(F.arrays_overlap("rules", F.array(*[F.lit(r.key) for r in rules])))
    # spans of a rule whose version is no longer current are left out
    current = F.exists("rules", lambda k: F.substring_index(k, "@", 1).eqNullSafe(F.col("s.name")) & k.isin([r.key for r in rules]))
    spans = log.select("blob", "rules", F.explode("spans").alias("s")).where(current).select(F.col("blob").alias("b"), F.struct(F.col("s.start").alias("start"), order.alias("order"), F.col("s.end").alias("end"), F.col("s.name").alias("name")).alias("s"))
    by_blob = spans.groupBy("b").agg(F.sort_array(F.collect_set("s")).alias("found"))
    rows = docs.drop("found").withColumn("_blob", F.sha2(whole_text(text_col), 256))
    empty = F.array().cast("array<struct<start: int, order: int, end: int, name: string>>")
    return rows.join(by_blob, F.col("_blob") == F.col("b"), "left").withColumn("found", F.coalesce("found", empty)).drop("_blob", "b")


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))))


def _named(names: list[str]) -> Callable[[Column], Column]:
    return lambda s: s["name"].isin(names)


def scan_documents(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, counts of the base rules, ``base_sha256`` and ``spans`` of every row."""
    ledger = ledger or new_folder(docs.sparkSession, "ledger")
    update_ledger(docs, ledger, rules, id_col, text_col)
    found = findings(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ledger, rules).select("doc_id", "found")
    base = [r.name for r in BASE_RULES]
    counts = [F.size(F.filter("found", _named([n]))).cast("long").alias(f"n_{n}") for n in base]
    listed = _listed(F.filter("found", _named(base)))
    return found.select(F.col("doc_id").alias(id_col), *counts, F.sha2(listed, 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def blotted(text: str | None, spans: list[tuple[int, int]], mark: str) -> str | None:
    """The text with sorted spans replaced; its pieces are joined once, so the time is that of reading it."""
    if not spans:
        return text
    pieces, at = [], 0
    for start, end in spans:
        if start >= at:
            pieces += (text[at:start], mark)
        at = max(at, end)
    return "".join(pieces) + text[at:]


def redact(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows with every found span replaced by ``mark``; overlapping spans become one. Null texts stay null."""
    ledger = ledger or new_folder(docs.sparkSession, "ledger")
    update_ledger(docs, ledger, rules, id_col, text_col)
    given = docs.withColumnRenamed("found", "_found")  # a column of theirs stays theirs
    names = given.columns

    def cut(batch: pa.RecordBatch) -> dict:
        pairs = zip(batch.column(text_col).to_pylist(), batch.column("found").to_pylist(), strict=True)
        return {c: batch.column(c) for c in names} | {text_col: [blotted(text, [(s["start"], s["end"]) for s in spans], mark) for text, spans in pairs]}

    found = findings(given, ledger, rules, text_col).select(*names, "found")
    return map_batches(found, cut, given.schema).toDF(*docs.columns)
