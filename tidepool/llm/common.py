"""Helpers shared by the document operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows and bytes of one Arrow batch between Spark and Python; bounds the memory of a task, not the result.
BATCH_ROWS = 2_000
BATCH_BYTES = 32 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Documents are long rows: hand fewer of them to Python at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def whole_text(text: str | Column = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def _kept() -> dict:
    return sys.modules.setdefault("_tidepool_worker", types.ModuleType("_tidepool_worker")).__dict__.setdefault("kept", {})


def per_process(key: Any, build: Callable[[], Any]) -> Any:
    """``build()`` once per Python worker; tasks of one worker share it until it works for another operator.

    Functions travel to the workers by value, so a module global would be fresh in every task.
    """
    kept = _kept()
    if key not in kept:
        kept[key] = build()
    return kept[key]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, Any]], schema: str | T.StructType) -> DataFrame:
    """Apply ``fn`` to Arrow batches; it returns one list or array per column of ``schema``."""
    small_batches(df.sparkSession)
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a worker outlives its operator: what another one kept would only take memory
        kept = _kept()
        if kept.get("operator") != fn.__module__:
            kept.clear()
            kept["operator"] = fn.__module__
        for batch in batches:
            got = fn(batch)
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def by_bytes(texts: list[str], most: int) -> Iterator[list[str]]:
    """Consecutive texts in groups of about ``most`` characters; a longer text is a group of its own."""
    group: list[str] = []
    held = 0
    for text in texts:
        if group and held + len(text) > most:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group
