"""Column expressions. All are built-in Spark functions, so they stay in generated code.

Missing and zero follow two different rules on purpose. Warehouse-style ratios turn a
zero into NULL; exploration-style ratios add a small epsilon. They are separate
functions and never one function with a switch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_nan(x: Column) -> Column:
    """NaN sorts above every number in Spark and poisons averages; treat it as missing."""
    return F.when(~F.isnan(x), x)


def change_vs(x: Column, before: Column) -> Column:
    """Relative change where a zero on either side means "unknown"."""
    return F.nullif(x, F.lit(0.0)) / F.nullif(before, F.lit(0.0)) - 1


def ratio_or_null(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0.0))


def ratio_eps(a: Column, b: Column, eps: float = 1e-10) -> Column:
    return F.try_divide(a, b + F.lit(eps))


def price_change(close: Column, open_: Column) -> Column:
    return F.try_divide(close, open_) - 1


def clip(x: Column, lo: Column | float | None = None, hi: Column | float | None = None) -> Column:
    """Bound ``x``; unlike least/greatest a missing value stays missing."""
    out = x
    if lo is not None:
        lo = lo if isinstance(lo, Column) else F.lit(float(lo))
        out = F.when(out < lo, lo).otherwise(out)
    if hi is not None:
        hi = hi if isinstance(hi, Column) else F.lit(float(hi))
        out = F.when(out > hi, hi).otherwise(out)
    return out


def safe_log(x: Column, eps: float = 1e-10) -> Column:
    return F.log(clip(x, lo=eps))


def log10_positive(x: Column) -> Column:
    return F.when(x > 0, F.log10(x))


def scale_fixed_point(x: Column, factor: float = 1e18) -> Column:
    """Fixed-point integers as text or number, scaled in double precision."""
    return x.try_cast("double") / F.lit(float(factor))


def digit_count(text: Column) -> Column:
    """Length of the source text. Counting digits of a double would count its exponent form."""
    return F.length(text.cast("string"))


def null_negative(x: Column) -> Column:
    return F.when(x >= 0, x)


def local_hour(ts: Column, offset: int = 9) -> Column:
    return F.pmod(F.hour(ts) + F.lit(offset), F.lit(24)).cast("int")


def pair_label(a: Column, b: Column) -> Column:
    return F.concat(a, F.lit("-"), b)


def short_label(text: Column, n: int = 8) -> Column:
    return F.concat(F.substring(text, 1, n), F.lit("..."))


def id_address(record_id: Column) -> Column:
    return F.get(F.split(record_id, "-"), F.lit(0))


def id_index(record_id: Column) -> Column:
    return F.get(F.split(record_id, "-"), F.lit(1))


def status(label: Column, names: dict[int, str]) -> Column:
    """Map class codes to display text; an unknown code gives NULL."""
    pairs = [F.lit(v) for item in names.items() for v in item]
    return F.create_map(*pairs)[label.cast("int")]


def spike_flag(x: Column, threshold: Column) -> Column:
    """1 at or above the threshold, 0 otherwise and for missing values."""
    return F.when(x >= threshold, 1).otherwise(0)


def is_true(pred: Column) -> Column:
    """A comparison with a missing value counts as false."""
    return F.coalesce(pred, F.lit(False))


def hour_key(name: Column) -> Column:
    """Hour a landed file stands for: ``YYYY-MM-DD_pool.jsonl`` means midnight,
    ``YYYYMMDDTHHMMSS_pool.jsonl`` is cut to the hour, any other name gives NULL.
    The dashes of the first form are kept, so the two forms never name one key."""
    dated = r"^(\d{4}-\d{2}-\d{2})_pool\.jsonl"
    stamped = r"^(\d{8}T\d{2})\d{4}_pool\.jsonl"
    return F.when(
        name.rlike(dated), F.concat(F.regexp_extract(name, dated, 1), F.lit("T000000"))
    ).when(name.rlike(stamped), F.concat(F.regexp_extract(name, stamped, 1), F.lit("0000")))


def all_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)
