"""Pool-hour tables derived from the test tables, so that every query reads real input.

``events`` plays the feed: a user is a pool, an event is one trade in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(x: Column) -> Column:
    """Two-decimal amounts, so that sums do not depend on their order."""
    return x.cast("decimal(18,2)")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _hour() -> Column:
    return F.date_trunc("hour", F.col("ts").cast("timestamp"))


def _dex() -> Column:
    return F.when(F.col("user_id") % 2 == 0, "dexa").otherwise("dexb")


def _pool() -> Column:
    return F.concat(F.lit("0x"), F.col("user_id").cast("string"))


def pool_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dex, pool_id, hour_ts, volume_usd, tvl_usd, liquidity; one row per pool and hour."""
    volume = F.sum(money(F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value"))))
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", _hour().alias("hour_ts"))
        .agg(
            volume.cast("double").alias("volume_usd"),
            (F.sum(_k()) - 3).cast("double").alias("tvl_usd"),
            F.count("*").cast("double").alias("liquidity"),
        )
        .select(_dex().alias("dex"), _pool().alias("pool_id"), "hour_ts", "volume_usd", "tvl_usd", "liquidity")
    )


def pool_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: pool, time, fee tier by event type, a value locked that may be negative."""
    tier = (
        F.when(F.col("event_type") == "view", 100)
        .when(F.col("event_type") == "click", 500)
        .when(F.col("event_type") == "signup", 3000)
        .when(F.col("event_type") == "purchase", 10000)
        .otherwise(30)
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        _pool().alias("pool_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        tier.alias("fee_tier"),
        (_k() - 3).cast("double").alias("tvl_usd"),
        "value",
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide exploration table: one typed row per pool-hour with pool attributes.

    ``hour_ts`` is epoch seconds here; ``liquidity_text`` and ``sqrt_price_text`` are the
    long fixed-point integers as the feed sends them.
    """
    hours = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.unix_timestamp(_hour()).alias("hour_ts"))
        .agg(
            F.sum(money(F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value")))).alias("_v"),
            F.sum(_k()).alias("_k"),
            F.count("*").alias("tx_count"),
            F.sum(money(F.col("value"))).alias("_all"),
            F.min_by("value", "event_id").alias("open_price"),
            F.max("value").alias("high_price"),
            F.min("value").alias("low_price"),
            F.max_by("value", "event_id").alias("close_price"),
        )
    )
    digits = F.concat((F.col("_k") + 1).cast("string"), F.repeat(F.lit("7"), (F.col("user_id") % 20 + 10).cast("int")))
    roots = F.concat((F.col("_k") + 11).cast("string"), F.repeat(F.lit("3"), (F.col("user_id") % 7 + 18).cast("int")))
    tiers = F.array(*[F.lit(t) for t in ("100", "500", "3000", "10000", "30")])
    index = F.floor(F.col("hour_ts") / 3600).cast("string")
    return hours.select(
        F.concat(_pool(), F.lit("-"), index).alias("id"),
        _pool().alias("pool_address"),
        index.alias("block_index"),
        "hour_ts",
        F.col("_v").cast("double").alias("volume_usd"),
        (F.col("_k") - 3).cast("double").alias("tvl_usd"),
        digits.cast("double").alias("liquidity"),
        (F.col("_all").cast("double") * 0.5).alias("volume_token0"),
        (F.col("_all").cast("double") * 2.0).alias("volume_token1"),
        (F.col("_v").cast("double") * 0.003).alias("fees_usd"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "tx_count",
        (F.col("_k") - 50).cast("double").alias("tick"),
        roots.cast("double").alias("sqrt_price"),
        (F.col("close_price") + 1).alias("token0_price"),
        (1 / (F.col("close_price") + 1)).alias("token1_price"),
        _dex().alias("protocol"),
        F.get(tiers, (F.col("user_id") % 5).cast("int")).alias("fee_tier"),
        F.concat(F.lit("T"), (F.col("user_id") % 7).cast("string")).alias("token0_symbol"),
        F.concat(F.lit("U"), (F.col("user_id") % 3).cast("string")).alias("token1_symbol"),
        digits.alias("liquidity_text"),
        roots.alias("sqrt_price_text"),
    )


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``wide`` as the feed delivers it: ``value`` holds one JSON record, numbers quoted.

    Also carries ``protocol``. Records of dexb have no fee tier, as one exchange omits it.
    """
    w = wide(spark, sf_dir)
    token = lambda c: F.struct(
        F.lower(F.col(c)).alias("id"), F.col(c).alias("symbol"), F.concat(F.lit("Token "), F.col(c)).alias("name"),
        F.lit("18").alias("decimals"),
    )
    pool = F.struct(
        F.col("pool_address").alias("id"),
        token("token0_symbol").alias("token0"),
        token("token1_symbol").alias("token1"),
        F.when(F.col("protocol") == "dexa", F.col("fee_tier")).alias("feeTier"),
    )
    text = lambda c, n: F.col(c).cast("string").alias(n)
    record = F.struct(
        "id",
        F.col("hour_ts").alias("periodStartUnix"),
        pool.alias("pool"),
        F.col("liquidity_text").alias("liquidity"),
        F.col("sqrt_price_text").alias("sqrtPrice"),
        text("token0_price", "token0Price"),
        text("token1_price", "token1Price"),
        text("tick", "tick"),
        text("tvl_usd", "tvlUSD"),
        text("volume_token0", "volumeToken0"),
        text("volume_token1", "volumeToken1"),
        text("volume_usd", "volumeUSD"),
        text("fees_usd", "feesUSD"),
        text("tx_count", "txCount"),
        text("open_price", "open"),
        text("high_price", "high"),
        text("low_price", "low"),
        text("close_price", "close"),
    )
    return w.select(F.to_json(record).alias("value"), "protocol")


def raw_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, period, volume, load_ts: each event-hour loaded twice, the later copy corrected by one."""
    w = wide(spark, sf_dir).select("id", F.col("hour_ts").alias("period"), "volume_usd")
    first = w.withColumn("load_ts", F.timestamp_seconds(F.col("period") + 3600))
    second = w.select("id", "period", F.col("volume_usd") + 1, F.timestamp_seconds(F.col("period") + 7200))
    return first.union(second)


def supplier_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger series for load tests: a supplier is a pool, a ship date is an hour."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("timestamp").alias("hour_ts"))
        .agg(
            F.sum(money(F.col("l_extendedprice"))).cast("double").alias("volume_usd"),
            (F.sum(F.col("l_quantity").cast("decimal(18,2)")) - 10).cast("double").alias("tvl_usd"),
            F.count("*").cast("double").alias("liquidity"),
        )
        .select(
            F.lit("dexa").alias("dex"),
            F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("pool_id"),
            "hour_ts",
            "volume_usd",
            "tvl_usd",
            "liquidity",
        )
    )
