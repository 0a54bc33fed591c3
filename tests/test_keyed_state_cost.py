"""What a series costs in the keyed state, and the merging of its rows, without a session."""

import math

import numpy as np
from pyspark.sql import Row

from tidepool.streaming import keyed_state as KS

HOUR = 3_600_000_000


class Held:
    """A value state that counts its calls."""

    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


class Handle:
    def __init__(self):
        self.states = []

    def getValueState(self, name, layout):  # noqa: N802
        self.states.append(Held())
        return self.states[-1]


def rows_of(values):
    return iter([Row(dex="a", pool_id="p", values=",".join(str(x) for x in v)) for v in values])


def test_a_batch_costs_a_series_two_calls_and_one_row():
    handle, processor = Handle(), KS._Series(["dex", "pool_id"], 72)
    processor.init(handle)
    assert len(handle.states) == 1
    rows = [(h * HOUR, 0, float(h), 2.0, 1.0) for h in range(500)]
    sent = list(processor.handleInputRows(("a", "p"), rows_of(rows), None))
    assert len(sent) == 1 and len(sent[0].hour_ts) == 500 and handle.states[0].calls == 2
    # 72 hours before the newest, the newest, and 24 before those, of five numbers each
    assert len(handle.states[0].value[0]) == (72 + 1 + 24) * 5 * 8
    late = list(processor.handleInputRows(("a", "p"), rows_of([(3 * HOUR, 0, 1.0, 1.0, 1.0), (499 * HOUR, 1, 9.0, 0.0, 1.0)]), None))
    assert [(r.passed, r.hour_ts, r.revision) for r in late] == [(True, [3 * HOUR], 2), (False, [499 * HOUR], 2)]
    assert late[1].volume_usd == [9.0] and math.isnan(late[1].vol_tvl_ratio[0]) and handle.states[0].calls == 4


def test_missing_numbers_and_load_times_come_first_and_copies_are_not_new():
    table = lambda rows: KS._table(np.array(rows, dtype=float).reshape(-1))
    nan = math.nan
    held = table([(1, 5, nan, 1, 1), (2, KS._NEVER, 3, 1, 1), (3, 5, 2, 2, nan)])
    fresh = table([(1, 5, -7, 1, 1), (2, 0, nan, 1, 1), (3, 5, 2, 2, nan), (3, 4, 9, 9, 9), (0, 1, 1, 1, 1)])
    both, new = KS._merged(held, fresh)
    assert both["hour_ts"].tolist() == [0, 1, 2, 3] and new.tolist() == [True, True, True, False]
    assert both["volume_usd"][1] == -7 and math.isnan(both["volume_usd"][2]) and both["volume_usd"][3] == 2


def test_means_take_what_is_known():
    with np.errstate(invalid="ignore"):
        made = KS._mean(np.array([math.nan, 1.0, 3.0, math.inf, math.nan, math.nan, math.nan]), 3)
    assert np.isnan(made).tolist() == [True, False, False, False, False, True, True]
    assert made[1:5].tolist() == [1.0, 2.0, 2.0, 3.0]
