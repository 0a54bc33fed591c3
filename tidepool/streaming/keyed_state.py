"""Row-based features with each series' rows held as keyed state, so that no stored table is read.

A series (exchange and pool) keeps its rows of the last ``lateness_hours`` before its newest hour, and the 24 rows
before those, which later windows reach back to. A batch's rows are put in their places; from the first place that changed
all rows are computed again and sent, each with the number of its sending (``revision``). Of the rows sent for an hour the one
with the highest revision counts (``latest``). Copies of an hour are merged as in the batch chain: the newest load stays.
A row older than all that a full state holds can't be placed: it is sent with ``passed`` and without features, never lost.

State needs RocksDB, which keeps it on disk and in the checkpoint. There are no timers: with one on processing time a run over
what is available never ends, since Spark always plans one more batch for it. Python sees one series at a time, and of it the batch's rows
and its state, both bounded by hours; this is the one place in the library where a window is computed in Python.

What is passed between Spark and Python is few and large: a row's five values come as one text, a series' state is one value (float64, the five
values row by row), read and written once a batch, and a sending is one row of arrays that Spark spreads into rows behind the operator. Points in
time are whole microseconds, which float64 holds exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidepool import schema as L
from tidepool.operators.features import LAG_ROWS, has_keys

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MEASURES = ["volume_usd", "tvl_usd", "liquidity"]
NAMES = ["vol_rate_24h", "tvl_rate_24h", "vol_ma_6h", "vol_ma_24h", "vol_tvl_ratio"]
_TIMES = ["hour_ts", "load_ts"]
_COLS = [*_TIMES, *MEASURES]
#: Stands for a load time that is missing; it sorts before all others.
_NEVER = -(2**63)
_HOUR = 3_600_000_000
_KIND = np.dtype("<f8")

_Table = dict[str, np.ndarray]


class _Series(StatefulProcessor):
    def __init__(self, series: Sequence[str], lateness_hours: int) -> None:
        self.series, self.lateness = list(series), lateness_hours * _HOUR
        self.sent = Row(*self.series, *_COLS, *NAMES, "revision", "passed")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "rows binary, revision long, cut boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        fresh = _table(np.array(",".join([r["values"] for r in rows]).split(","), dtype=_KIND))
        stored, revision, cut = self.held.get() or (b"", 0, False)
        held = _table(np.frombuffer(stored, dtype=_KIND))
        passed = fresh["hour_ts"] < held["hour_ts"][LAG_ROWS] if cut else np.zeros(len(fresh["hour_ts"]), bool)
        if passed.any():
            yield self._out(key, _taken(fresh, passed), revision + 1, True)
        both, new = _merged(held, _taken(fresh, ~passed))
        changed = np.flatnonzero(new)
        if len(changed):
            made = {**both, **_features(both)}
            yield self._out(key, _taken(made, slice(changed[0], None)), revision + 1, False)
        start = max(int((both["hour_ts"] < both["hour_ts"][-1] - self.lateness).sum()) - LAG_ROWS, 0)
        kept = np.column_stack([both[c][start:] for c in _COLS]).astype(_KIND)
        self.held.update((kept.tobytes(), revision + 1, bool(cut or start > 0)))

    def close(self) -> None:
        pass

    def _out(self, key, rows: _Table, revision: int, passed: bool) -> Row:
        times = [rows[c].astype(np.int64).tolist() for c in _TIMES]
        blank = [None] * len(times[0])
        return self.sent(*key, *times, *(rows[c].tolist() if c in rows else blank for c in [*MEASURES, *NAMES]), revision, passed)


def _arrays(cols: Sequence[str]) -> str:
    return ", ".join(f"{c} array<{'long' if c in _TIMES else 'double'}>" for c in cols)


def _table(values: np.ndarray) -> _Table:
    """A column each from values that lie row by row; a missing number is NaN."""
    return dict(zip(_COLS, values.reshape(-1, len(_COLS)).T))


def _taken(table: _Table, which) -> _Table:
    return {c: v[which] for c, v in table.items()}


def _merged(held: _Table, fresh: _Table) -> tuple[_Table, np.ndarray]:
    """One row per hour, in order of time, and which of them the batch brought.

    The newest load stays, among loads of one time the larger measures, and what is held rather than a copy of it.
    """
    both = {c: np.concatenate([held[c], fresh[c]]) for c in _COLS}
    new = np.arange(len(both["hour_ts"])) >= len(held["hour_ts"])
    keys = [~new]
    for c in reversed(MEASURES):
        keys += [both[c], ~np.isnan(both[c])]  # a missing number comes first
    order = np.lexsort([*keys, both["load_ts"], both["hour_ts"]])
    hours = both["hour_ts"][order]
    last = order[np.append(hours[1:] != hours[:-1], True)]
    return _taken(both, last), new[last]


def _features(rows: _Table) -> _Table:
    """The five features over rows in order of time; zero and missing sides give no rate or ratio."""
    volume, locked = rows["volume_usd"], rows["tvl_usd"]
    with np.errstate(all="ignore"):
        return {
            "vol_rate_24h": _positive(volume) / _positive(_before(volume)) - 1,
            "tvl_rate_24h": _positive(locked) / _positive(_before(locked)) - 1,
            "vol_ma_6h": _mean(volume, 6),
            "vol_ma_24h": _mean(volume, 24),
            "vol_tvl_ratio": volume / _positive(locked),
        }


def _positive(v: np.ndarray) -> np.ndarray:
    return np.where(v != 0, v, np.nan)


def _before(v: np.ndarray) -> np.ndarray:
    return np.concatenate([np.full(min(LAG_ROWS, len(v)), np.nan), v[:-LAG_ROWS]])


def _mean(v: np.ndarray, rows: int) -> np.ndarray:
    """Mean of the finite among the last ``rows`` values, missing where there is none."""
    known = np.isfinite(v)
    last = lambda x: np.lib.stride_tricks.sliding_window_view(np.concatenate([np.zeros(rows - 1), x]), rows).sum(axis=1)
    return last(np.where(known, v, 0.0)) / last(known)


def keyed_features(
    hours: DataFrame, series: Sequence[str] = tuple(L.SERIES_KEY), lateness_hours: int = 72
) -> DataFrame:
    """The stream of computed rows from a stream of hours with ``load_ts``. Rows without a key or hour have no series
    and are left out; ``features_batch`` shows how to keep them beside."""
    hours.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    kinds = dict(hours.dtypes)
    keys = ", ".join(f"{k} {kinds[k]}" for k in series)
    layout = f"{keys}, {_arrays([*_COLS, *NAMES])}, revision long, passed boolean"
    values = [F.coalesce(F.unix_micros(F.col(c).cast("timestamp")).cast("string"), F.lit(str(_NEVER))) for c in _TIMES]
    values += [F.coalesce(F.col(c).cast("double").cast("string"), F.lit("NaN")) for c in MEASURES]
    whole = hours.where(has_keys([*series, "hour_ts"])).select(*series, F.concat_ws(",", *values).alias("values"))
    processor = _Series(series, lateness_hours)
    sent = whole.groupBy(*series).transformWithState(processor, layout, "Append", "None")
    rows = sent.select(*series, F.explode(F.arrays_zip(*_COLS, *NAMES)).alias("_row"), "revision", "passed")
    spread = [_time(F.col("_row")[c]).alias(c) for c in _TIMES]
    spread += [F.when(~F.isnan(F.col("_row")[c]), F.col("_row")[c]).alias(c) for c in [*MEASURES, *NAMES]]
    return rows.select(*series, *spread, "revision", "passed")


def _time(micros: Column) -> Column:
    return F.when(micros != F.lit(_NEVER), F.timestamp_micros(micros))


def run(stream: DataFrame, checkpoint: str, path: str) -> None:
    """Send all that has arrived to a parquet folder."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.format("parquet").start(path).awaitTermination()


def latest(sent: DataFrame, series: Sequence[str] = tuple(L.SERIES_KEY)) -> DataFrame:
    """Of the rows sent for an hour the last: a rank whose limit applies before the shuffle."""
    order = Window.partitionBy(*series, "hour_ts").orderBy(F.desc("revision"))
    ranked = sent.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")
    # sendings of earlier versions may hold NaN for missing; no feature of known numbers is one
    return ranked.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in NAMES})
