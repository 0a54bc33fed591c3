"""One-row results next to the rows they apply to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, one_row: DataFrame, name: str = "_one") -> DataFrame:
    """Add a struct column holding the single row of ``one_row``.

    It is a scalar subquery: evaluated once and sent along as a constant, without a join.
    As a column of its own it is planned once, however often its fields are used.
    """
    return df.withColumn(name, scalar_struct(one_row))


def scalar_struct(one_row: DataFrame) -> Column:
    return one_row.select(F.struct(*one_row.columns).alias("s")).scalar()
