"""Typed access to JSON text or VARIANT columns. A path that is absent gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepool.functions.scalars import not_nan


def json_str(col: Column, path: str, variant: bool = False) -> Column:
    """The value at ``path`` (``"pool.token0.id"``) as unquoted text."""
    if variant:
        return F.try_variant_get(col, f"$.{path}", "string")
    return F.get_json_object(col, f"$.{path}")


def json_float(col: Column, path: str, variant: bool = False) -> Column:
    """A number; the text NaN counts as missing."""
    return not_nan(json_str(col, path, variant).try_cast("double"))


def json_ts(col: Column, path: str, variant: bool = False) -> Column:
    """Epoch seconds at ``path`` as a timestamp."""
    return epoch_to_ts(json_str(col, path, variant))


def epoch_to_ts(col: Column) -> Column:
    return F.timestamp_seconds(col.try_cast("bigint"))
