"""Tests on count tables and seasonal decomposition of daily series.

The test functions take tables that are already counted (one row per category). Pairwise
tests are quadratic in the number of categories by nature, so that number is checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.functions.probability import chi2_p, normal_p
from tidepool.operators.attach import attach

MAX_CATEGORIES = 1000


def chi2_uniform(counts: DataFrame, col: str = "count") -> DataFrame:
    """Chi-square goodness of fit against equal expectation. Give zero rows for unseen categories."""
    totals = counts.agg(
        F.sum(col).alias("n"), F.count("*").alias("k"), F.sum(F.col(col).cast("double") * F.col(col)).alias("sq")
    )
    expected = F.col("n") / F.col("k")
    # sum((o - e)^2 / e) = sum(o^2) / e - n, since the observed counts add up to n
    out = totals.select((F.try_divide("sq", expected) - F.col("n")).alias("chi2"), (F.col("k") - 1).alias("df"))
    return out.withColumn("p", chi2_p("chi2", F.col("df").cast("double")))


def chi2_independence(tbl: DataFrame, cols: Sequence[str] = ("neg", "valid")) -> DataFrame:
    """Chi-square independence of the table's rows and the count columns ``cols``, with Cramér's V.

    With one degree of freedom each deviation is first reduced by a half (or by itself if
    smaller), which is Yates' continuity correction.
    """
    row = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    totals = tbl.agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in cols])
    whole = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    totals = totals.select("rows", whole.alias("n"), *cols)
    t = F.col("_one")
    freedom = (t["rows"] - 1) * (len(cols) - 1)

    def cell(c):
        expected = F.try_divide(row * t[c], t["n"])
        gap = F.abs(F.col(c) - expected)
        gap = F.when(freedom == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.try_divide(gap * gap, expected)

    chi2 = attach(tbl, totals).agg(F.sum(sum((cell(c) for c in cols[1:]), cell(cols[0]))).alias("chi2"))
    smaller = F.least(t["rows"], F.lit(len(cols)).cast("bigint"))
    out = attach(chi2, totals).select(
        "chi2",
        freedom.cast("int").alias("df"),
        t["n"].alias("n"),
        F.sqrt(F.try_divide("chi2", t["n"] * (smaller - 1))).alias("cramers_v"),
    )
    return out.withColumn("p", chi2_p("chi2", F.col("df").cast("double")))


def cramers_v(tbl: DataFrame, cols: Sequence[str] = ("neg", "valid")) -> DataFrame:
    return chi2_independence(tbl, cols).select("cramers_v")


def trend_test(tbl: DataFrame, weight: str = "fee_tier", centering: str = "plain") -> DataFrame:
    """Cochran-Armitage trend of the ``neg`` share over ordered categories.

    ``centering='plain'`` centres the weights by their plain mean over categories;
    ``'weighted'`` by their mean over rows, as in the textbook statistic.
    """
    w = F.col(weight).cast("double")
    size = F.col("neg") + F.col("valid")
    middle = F.avg(w) if centering == "plain" else F.sum(w * size) / F.sum(size)
    totals = tbl.agg(middle.alias("w"), F.sum(size).alias("n"), F.sum("neg").alias("m"))
    t = F.col("_one")
    n, m = t["n"].cast("double"), t["m"].cast("double")
    lean = attach(tbl, totals).agg(
        F.sum((w - t["w"]) * (F.col("neg") - size * m / n)).alias("num"),
        F.sum(size * (w - t["w"]) * (w - t["w"])).alias("spread"),
    )
    z = F.try_divide("num", F.sqrt(F.try_divide(m * (n - m) * F.col("spread"), n * (n - 1))))
    return attach(lean, totals).select(z.alias("z")).withColumn("p", normal_p("z"))


def pairwise_z(tbl: DataFrame, category: str = "fee_tier") -> DataFrame:
    """Pooled two-proportion z test between every two categories."""
    item = F.struct(F.col(category).alias("c"), F.col("neg").alias("x"), (F.col("neg") + F.col("valid")).alias("n"))
    row = tbl.groupBy().agg(F.sort_array(F.collect_list(item)).alias("a"), F.count("*").alias("_size"))
    row = row.where(
        F.assert_true(F.col("_size") <= MAX_CATEGORIES, "too many categories for tests between all of them").isNull()
    )
    pairs = F.flatten(
        F.transform(
            "a",
            lambda left, i: F.transform(
                F.slice("a", i + 2, F.size("a")), lambda right: F.struct(left.alias("l"), right.alias("r"))
            ),
        )
    )
    both = row.select(F.explode(pairs).alias("p")).select("p.l", "p.r")
    share = lambda side: F.try_divide(f"{side}.x", f"{side}.n")
    pooled = F.try_divide(F.col("l.x") + F.col("r.x"), F.col("l.n") + F.col("r.n"))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), "l.n") + F.try_divide(F.lit(1.0), "r.n")))
    out = both.select(
        F.col("l.c").alias("a"), F.col("r.c").alias("b"), F.try_divide(share("l") - share("r"), error).alias("z")
    )
    return out.withColumn("p", normal_p("z"))


def holm(tests: DataFrame, p: str = "p", family: Sequence[str] = (), out: str = "p_adj") -> DataFrame:
    """Holm's step-down adjustment within each family of tests.

    A family is a set of tests made together, such as all pairs of categories. Without
    ``family`` the whole frame is one, so it must be a finished report and not data rows.
    """
    groups = [F.col(f) for f in family] or [F.lit(0)]
    ordered = Window.partitionBy(*groups).orderBy(p)
    rank = F.row_number().over(ordered)
    size = F.count(p).over(Window.partitionBy(*groups))
    raw = tests.withColumn("_step", (size - rank + 1) * F.col(p))
    highest = F.max("_step").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    return raw.withColumn(out, F.least(highest, F.lit(1.0))).drop("_step")


def decompose(
    daily: DataFrame, by: Sequence[str] = (), ts: str = "date", col: str = "volume_usd", period: int = 7
) -> DataFrame:
    """Additive trend, season and rest of a gap-free daily series.

    The trend is the centred moving average over one period and is missing near the ends;
    the season is the mean deviation from it per position in the period, centred to zero.
    A series has one row per calendar day, which bounds its window.
    """
    series = Window.partitionBy(*by).orderBy(ts)
    half = period // 2
    x = F.col(col)
    if period % 2:
        frame = series.rowsBetween(-half, half)
        trend = F.when(F.count(x).over(frame) == period, F.avg(x).over(frame))
    else:
        inner, outer = series.rowsBetween(1 - half, half - 1), series.rowsBetween(-half, half)
        total = (F.sum(x).over(inner) + F.sum(x).over(outer)) / (2 * period)
        trend = F.when(F.count(x).over(outer) == period + 1, total)
    placed = daily.select(
        "*", trend.alias("trend"), F.pmod(F.row_number().over(series) - 1, F.lit(period)).alias("phase")
    )
    raw = placed.withColumn("_raw", F.avg(x - F.col("trend")).over(Window.partitionBy(*by, "phase")))
    # the mean over phases, each phase counted once: its first period carries one row per phase
    first = F.when(F.row_number().over(series) <= period, F.col("_raw"))
    centred = raw.withColumn("_first", first).withColumn("_mean", F.avg("_first").over(Window.partitionBy(*by)))
    return centred.select(
        *by, ts, col, "phase", "trend", (F.col("_raw") - F.col("_mean")).alias("seasonal"),
        (x - F.col("trend") - (F.col("_raw") - F.col("_mean"))).alias("resid"),
    )
