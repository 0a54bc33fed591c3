"""Sessions and gaps as merged intervals, against a walk along each series."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidepool.operators import combine
from tidepool.streaming.jobs import sessions

GAP = timedelta(hours=6)


def _walk(rows):
    series = defaultdict(list)
    for pool, t in rows:
        if t is not None:
            series[pool].append(t)
    out = []
    for pool, times in series.items():
        times.sort()
        at = [times[0], times[0], 0]
        for t in times:
            if t > at[1] + GAP:
                out.append((pool, at[0], at[1] + GAP, at[2]))
                at = [t, t, 0]
            at[1], at[2] = t, at[2] + 1
        out.append((pool, at[0], at[1] + GAP, at[2]))
    return sorted(map(str, out))


@pytest.mark.parametrize("together", [1, 2, 7, 4096])
def test_sessions_equal_a_walk(spark, monkeypatch, together):
    """A third of the rows in one pool, stamps before 1970, ties, stamps exactly a gap apart, chunks of few intervals."""
    monkeypatch.setattr(combine, "MERGED_TOGETHER", together)
    rng = random.Random(together)
    start = datetime(1969, 12, 20, tzinfo=UTC)
    rows = [("hot", start + timedelta(minutes=rng.choice([1, 30, 359, 360, 361]) * rng.randint(0, 90))) for _ in range(300)]
    rows += [(rng.choice(["a", "b", None]), start + timedelta(hours=rng.randint(0, 900))) for _ in range(500)]
    rows += [("exact", start + k * GAP) for k in range(40)] + [("over", start + k * (GAP + timedelta(microseconds=1))) for k in range(40)]
    rows += [("none", None), rows[0], rows[1]]
    df = spark.createDataFrame(rows, "pool_id string, ts timestamp").repartition(6)
    found = sessions(df, gap="6 hours")
    micros = lambda t: datetime.fromtimestamp(0, UTC) + timedelta(microseconds=t)
    got = [(r["pool_id"], micros(r["s"]), micros(r["e"]), r["rows"]) for r in found.select("pool_id", F.unix_micros("start").alias("s"), F.unix_micros("end").alias("e"), "rows").collect()]
    assert sorted(map(str, got)) == _walk(rows)


def test_one_bad_stamp_is_one_row(spark):
    day = datetime(2024, 1, 5, tzinfo=UTC)
    rows = [("p", day), ("p", day + timedelta(hours=1)), ("p", day + timedelta(days=3)), ("p", datetime(9999, 1, 1, tzinfo=UTC)), ("q", None), ("q", day)]
    df = spark.createDataFrame(rows, "pool_id string, ts timestamp")
    bounds = ("ts", ["pool_id"], date(2024, 1, 1), date(2024, 1, 31))
    spans = combine.missing_spans(df, *bounds)
    assert [(r["pool_id"], r["first"].hour, r["last"].hour, r["hours"]) for r in spans.collect()] == [("p", 2, 23, 70)]
    assert sorted((r["pool_id"], r["rows"]) for r in combine.outside_range(df, *bounds).collect()) == [("p", 1), ("q", 1)]
    assert combine.missing_spans(df.limit(0), *bounds).count() == 0
