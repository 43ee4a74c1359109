"""Waiting budget steps are held as packed tables: a row of state per table, the same decisions however they are cut."""

import random
from types import SimpleNamespace

import pandas as pd
import pytest

from callweave.streaming import budget

COLUMNS = ["at_us", "later", "event_id", "request_id", "status", "inr"]


class State:
    """A state variable of any kind in memory."""

    def __init__(self):
        self.held, self.value, self.rows = {}, None, []

    exists = lambda self: bool(self.rows) or self.value is not None
    get = lambda self: list(self.rows) if self.rows else self.value
    update = lambda self, value: setattr(self, "value", value)
    appendList = lambda self, rows: self.rows.extend(rows)
    put = lambda self, rows: setattr(self, "rows", list(rows))
    containsKey = lambda self, k: k in self.held
    getValue = lambda self, k: self.held[k]
    updateValue = lambda self, k, v: self.held.__setitem__(k, v)
    removeKey = lambda self, k: self.held.pop(k, None)
    iterator = lambda self: iter(list(self.held.items()))

    def clear(self):
        self.value, self.rows = None, []


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def state(self, name, *_):
        return self.states.setdefault(name, State())

    getValueState = getListState = getMapState = state
    registerTimer = lambda self, at: self.timers.add(at)
    deleteTimer = lambda self, at: self.timers.discard(at)


def recorded(n):
    """Reservations a second apart, most closed 40 seconds later; the first hundred stay open; one event comes twice."""
    rng, steps = random.Random(5), []
    for i in range(n):
        at = i * 1_000_000 + rng.randrange(500_000)
        steps.append((at, 0, i, f"R{i}", "reserved", float(rng.randrange(1, 9))))
        if i >= 100 and i % 5:
            steps.append((at + 40_000_000, 1, i, f"R{i}", rng.choice(["usage_reported", "rejected_not_billed", "kept", None]), float(rng.randrange(1, 9))))
    return steps + steps[-1:]


def run(steps, marks, cap=1500.0, size=50):
    """(request, decision, committed) in the order they are published, and the state: the steps come in parts of rows between the marks, shuffled."""
    handle, got, most = Handle(), [], 0
    processor = budget.BudgetProcessor(cap)
    processor.init(handle)
    for low, high in zip([0, *marks], [*marks, 10**12]):
        part = [s for s in steps if low <= s[2] * 1_000_000 < high]
        random.Random(low).shuffle(part)
        frames = [pd.DataFrame(part[i:i + size] + [(0, 0, None, None, None, None)], columns=COLUMNS) for i in range(0, len(part), size)]
        got += list(processor.handleInputRows(("B1",), iter(frames), SimpleNamespace(getCurrentWatermarkInMs=lambda: low // 1000)))
        most = max(most, len(handle.states["waiting"].rows))
        for timer in sorted(t for t in handle.timers if t < high // 1000):
            handle.timers.discard(timer)
            got += list(processor.handleExpiredTimer(("B1",), SimpleNamespace(getCurrentWatermarkInMs=lambda: high // 1000), None))
    assert not any(f["late"].any() for f in got)
    return [tuple(r) for f in got for r in f[["request_id", "decision", "committed_inr"]].itertuples(index=False)], handle, most


def plain(steps, cap=1500.0):
    total, held, out = 0.0, {}, []
    for _, later, _, request, status, inr in sorted(steps, key=lambda s: s[:4]):
        decision, total, now = budget.decide(total, held.get(request) if later else None, "close" if later else "reserve", status, inr, cap)
        if now is not None:
            held[request] = now
        elif later:
            held.pop(request, None)
        out.append((request, decision, total))
    return out, held


@pytest.mark.parametrize("size", [100_000, 64])
def test_decisions_do_not_depend_on_how_steps_are_held(monkeypatch, size):
    monkeypatch.setattr(budget, "HELD", size, raising=False)
    steps = recorded(1500)
    got, handle, _ = run(steps, [300_000_000, 320_000_000, 900_000_000])
    want, held = plain(steps)
    assert got == want and {d for _, d, _ in want} == {"accepted", "refused", "settled", "released", "kept", "ignored"}
    assert handle.states["open"].held == {(k,): (v,) for k, v in held.items()} and len(held) > 64
    assert not handle.states["waiting"].rows and handle.states["total"].value[2] == len(held)


def test_waiting_steps_are_few_rows_of_state():
    _, handle, most = run(recorded(1500), [300_000_000, 900_000_000])
    assert most <= 2


def test_an_export_without_steps_holds_nothing():
    processor, handle = budget.BudgetProcessor(10.0), Handle()
    processor.init(handle)
    empty = pd.DataFrame([(None,) * 6], columns=COLUMNS)
    assert not list(processor.handleInputRows(("B1",), iter([empty]), SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)))
    assert not list(processor.handleExpiredTimer(("B1",), SimpleNamespace(getCurrentWatermarkInMs=lambda: 5), None))
    assert not handle.timers and not handle.states["waiting"].rows
