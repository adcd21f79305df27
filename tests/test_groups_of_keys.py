"""Rows put in order work on groups of keys: one call of the processor for many keys, with exact keys and values."""

import pandas as pd
import pyarrow as pa

from sessionlake.streaming import ordered


class Held:
    """State of one group in memory that counts its calls."""

    def __init__(self):
        self.values, self.calls, self.timers = {}, 0, []

    def state(self, name, *_):
        held = self

        class Value:
            def exists(self):
                return bool(held.values.get(name))

            def get(self):
                held.calls += 1
                return held.values[name]

            def appendValue(self, value):
                held.calls += 1
                held.values.setdefault(name, []).append(value)

            def put(self, values):
                held.calls += 1
                held.values[name] = values

            def update(self, value):
                held.calls += 1
                held.values[name] = value

            def clear(self):
                held.calls += 1
                held.values.pop(name, None)

        return Value()

    getListState = getValueState = state  # noqa: N815  as Spark's handle

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


def test_a_call_works_on_many_keys_and_reads_state_once():
    held, n, big = Held(), 500, (1 << 53) + 1
    clock = ordered.StrictClock()
    clock.init(held)
    keys = [None, *(str(big + k) for k in range(n))]
    for part in (0, 1):
        rows = [(k, 1000 * (2 * part + j), big + j, 7, False) for k in keys for j in (0, 1)] + [(None, 0, 0, 0, True)]
        list(clock.handleInputRows((3,), iter([pd.DataFrame(rows, columns=["key", "at", "row_index", "t", "mark"])]), Watermark(0)))
    out = pd.concat(clock.handleExpiredTimer((3,), Watermark(3), None))  # the last row of each key still waits
    out = pd.concat([out, *clock.handleExpiredTimer((3,), Watermark(5), None)])
    got = {}
    for k, i, c in zip(out["key"], out["row_index"], out["clock"], strict=True):
        got.setdefault(k, []).append((i, c))
    assert got == {k: [(big, 7), (big + 1, 8), (big, 9), (big + 1, 10)] for k in keys}
    assert held.calls < 20


def test_groups_of_batches_end_key_by_key():
    held = Held()
    flush = ordered.Batches(2, 10_000)
    flush.init(held)
    rows = pa.table({"key": ["a", "b", "a", "a", "b"], "at": [1000, 1000, 2000, 3000, 30_000], "row_index": [0, 1, 2, 3, 4], "t": [1] * 5, "mark": [False] * 5}).to_pandas()
    list(flush.handleInputRows((0,), iter([rows]), Watermark(0)))
    out = pd.concat(flush.handleExpiredTimer((0,), Watermark(31), None))
    assert sorted(out.itertuples(index=False, name=None)) == [("a", 1000, 2000, 2, 2), ("a", 3000, 3000, 1, 1), ("b", 1000, 1000, 1, 1)]
    assert held.timers[-1] == 41 and [*pd.concat(flush.handleExpiredTimer((0,), Watermark(41), None)).itertuples(index=False, name=None)] == [("b", 30_000, 30_000, 1, 1)]
