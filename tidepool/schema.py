"""Record layout of one pool-hour and the column lists shared by the operators."""

from pyspark.sql import types as T


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


TOKEN = _texts("id", "symbol", "name", "decimals")

POOL = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("token0", TOKEN),
        T.StructField("token1", TOKEN),
        T.StructField("feeTier", T.StringType()),
    ]
)

# Every leaf is read as text: the feed quotes its numbers, and typing happens in
# staging with try_cast, so one odd value costs one NULL and not the whole line.
RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("periodStartUnix", T.StringType()),
        T.StructField("pool", POOL),
        *[
            T.StructField(n, T.StringType())
            for n in (
                "liquidity", "sqrtPrice", "token0Price", "token1Price", "tick",
                "feeGrowthGlobal0X128", "feeGrowthGlobal1X128", "tvlUSD",
                "volumeToken0", "volumeToken1", "volumeUSD", "feesUSD", "txCount",
                "open", "high", "low", "close",
            )
        ],
    ]
)

POOL_HOUR_KEY = ["pool_id", "hour_ts"]
#: What makes a series: two exchanges may use one pool id.
SERIES_KEY = ["dex", "pool_id"]

# Column names of the feed and of the tables made from it.
STAGED = {
    "pool_id": "pool.id",
    "token0_id": "pool.token0.id",
    "token1_id": "pool.token1.id",
}
STAGED_MEASURES = {
    "tvl_usd": "tvlUSD",
    "volume_usd": "volumeUSD",
    "liquidity": "liquidity",
    "open": "open",
    "high": "high",
    "low": "low",
    "close": "close",
}

#: The same fields as they lie in a record.
STAGED_RECORD = (
    "struct<periodStartUnix string, pool struct<id string, token0 struct<id string>, token1 struct<id string>>, "
    + ", ".join(f"{p} string" for p in STAGED_MEASURES.values())
    + ">"
)

CLEAN_DOUBLES = {
    "volume_usd": "volumeUSD",
    "tvl_usd": "tvlUSD",
    "liquidity": "liquidity",
    "volume_token0": "volumeToken0",
    "volume_token1": "volumeToken1",
    "fees_usd": "feesUSD",
    "open_price": "open",
    "high_price": "high",
    "low_price": "low",
    "close_price": "close",
    "tick": "tick",
    "sqrt_price": "sqrtPrice",
    "token0_price": "token0Price",
    "token1_price": "token1Price",
}

METADATA = {
    "fee_tier": "pool.feeTier",
    **{
        f"{token}_{field}": f"pool.{token}.{field}"
        for token in ("token0", "token1")
        for field in ("id", "symbol", "name", "decimals")
    },
}

# The thirteen measures that cleaning turns into numbers.
NUMERIC = [
    "volume_usd", "tvl_usd", "fees_usd", "open_price", "high_price", "low_price",
    "close_price", "liquidity", "volume_token0", "volume_token1", "tx_count",
    "tick", "sqrt_price",
]

# The model inputs.
MART_FEATURES = [
    "tvl_usd", "volume_usd", "liquidity", "vol_rate_24h", "tvl_rate_24h",
    "vol_ma_6h", "vol_ma_24h", "vol_tvl_ratio",
]
NOT_FEATURES = ["dex", "pool_id", "hour_ts", "y"]

EXPLORATION_FEATURES = [
    "volume_usd", "tvl_usd", "tx_count", "volume_deviation", "volume_tvl_ratio",
    "price_change",
]
