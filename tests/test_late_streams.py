"""Streams whose rows come late and in parts, against plain sums over all rows."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from callweave.operators.journeys import last_live, outcomes
from callweave.plans import worklist as wl
from callweave.streaming import budget, late, refresh

EVENTS = "event_id long, recorded_at timestamp_ntz, call_id string, stage string, status string, external_cost_inr double"
START = dt.datetime(2026, 3, 1)


@pytest.fixture(scope="module")
def events():
    rng = random.Random(1)
    return [(i, START + dt.timedelta(minutes=rng.randrange(9 * 1440), seconds=rng.randrange(60)), rng.choice(["C1", "C2", "C3", "C4", None]),
             rng.choice(["asr", "asr", "asr", "extract"]), rng.choice(["failed", "success"]), float(rng.randrange(40))) for i in range(700)]


def in_parts(spark, rows, layout, schema=EVENTS, at="recorded_at"):
    parts = [spark.createDataFrame(part, schema) for part in layout(rows)]
    return [*parts, late.end_of_export(spark.createDataFrame(rows, schema), at)]


def by_time(n):
    def layout(rows):
        rows = sorted(rows, key=lambda r: r[1])
        size = -(-len(rows) // n)
        return [rows[i:i + size] for i in range(0, len(rows), size)]
    return layout


LAYOUTS = {"whole": lambda rows: [rows], "backwards": lambda rows: by_time(3)(rows)[::-1], "at random": lambda rows: [rows[0::2], rows[1::2]]}


@pytest.mark.parametrize("name", LAYOUTS)
def test_windows_and_late_rows_hold_every_event(spark, events, name):
    parts = in_parts(spark, events, LAYOUTS[name])
    out = late.drain_parts(parts, late.window_ledger, "windows").cache()
    want = defaultdict(lambda: [0, 0.0, 0])
    for _, at, _, stage, status, cost in events:
        cell = want[dt.datetime(at.year, at.month, at.day), stage]
        cell[0], cell[1], cell[2] = cell[0] + 1, cell[1] + cost, cell[2] + (status == "failed")
    got = late.settled_windows(out).collect()
    assert {(r.start_at.replace(tzinfo=None), r.stage): [r.events, r.cost_inr, r.failures] for r in got} == want
    # The late ones are exactly the events whose day was over by more than the delay when their part came.
    overdue, mark = set(), None
    for part in LAYOUTS[name](events):
        overdue |= {r[0] for r in part if mark and dt.datetime(r[1].year, r[1].month, r[1].day) + dt.timedelta(days=1) < mark - dt.timedelta(days=1)}
        mark = max(r[1] for r in part) if mark is None else max(mark, max(r[1] for r in part))
    assert {r.event_id for r in out.where("kind = 'late'").collect()} == overdue
    assert bool(overdue) == (name in ("backwards", "at random"))
    assert sum(r.late_events for r in got) == len(overdue)


@pytest.mark.parametrize("name", ["whole", "backwards"])
def test_sessions_and_late_rows_hold_every_event(spark, events, name):
    out = late.drain_parts(in_parts(spark, events, LAYOUTS[name]), late.session_ledger, "sessions").cache()
    want, gap = [], dt.timedelta(minutes=30)
    for call in {r[2] for r in events}:
        times = sorted(r[1] for r in events if r[2] == call)
        start, last, n = times[0], times[0], 0
        for t in times:
            if t >= last + gap:
                want.append((call, start, last + gap, n))
                start, n = t, 0
            last, n = t, n + 1
        want.append((call, start, last + gap, n))
    got = [(r.call_id, r.start_at.replace(tzinfo=None), r.end_at.replace(tzinfo=None), r.events) for r in late.settled_sessions(out).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert (out.where("kind = 'late'").count() > 0) == (name == "backwards")


REQUESTS = "event_id long, ts timestamp_ntz, budget_id string, request_id string, reserve_inr double, final_status string, final_inr double"


def requests(n=240):
    rng = random.Random(7)
    ends = ["usage_reported", "rejected_not_billed", "uncertain_reserve_retained", "reserved"]
    return [(i, START + dt.timedelta(minutes=rng.randrange(12 * 1440)), rng.choice("AB"), f"R{i}", float(rng.randrange(1, 30)), rng.choice(ends), float(rng.randrange(40))) for i in range(n)]


def plain_decisions(rows, cap):
    steps = [(r[1], 0, r[0], r[2], r[3], "reserved", r[4]) for r in rows]
    steps += [(r[1] + dt.timedelta(hours=6), 1, r[0], r[2], r[3], r[5], r[6]) for r in rows if r[5] != "reserved"]
    total, held, out = defaultdict(float), {}, []
    for at, later, _, owner, request, status, inr in sorted(steps):
        if not later:
            ok = total[owner] + inr <= cap
            decision = "accepted" if ok else "refused"
            if ok:
                total[owner] += inr
                held[request] = inr
        else:
            had = held.pop(request, None)
            decision = "ignored" if had is None else {"usage_reported": "settled", "rejected_not_billed": "released"}.get(status, "kept")
            total[owner] += 0 if had is None else inr - had if decision == "settled" else -had if decision == "released" else 0
        out.append((owner, at, request, decision, total[owner]))
    return sorted(out)


def decided(spark, rows, layout, delay="1 day"):
    parts = in_parts(spark, rows, layout, REQUESTS, "ts")
    return late.drain_parts(parts, lambda s: budget.enforce(budget.steps(s), 900.0, delay=delay), "budget").collect()


@pytest.mark.parametrize("n", [1, 3, 6])
def test_budget_decisions_do_not_depend_on_the_parts(spark, n):
    rows = requests()
    got = decided(spark, rows, by_time(n))
    want = plain_decisions(rows, 900.0)
    assert {d for *_, d, _ in want} == {"accepted", "refused", "settled", "released", "kept", "ignored"}
    assert sorted((r.budget_id, r.ts.replace(tzinfo=None), r.request_id, r.decision, r.committed_inr) for r in got) == want
    assert not any(r.late for r in got)


def test_late_budget_steps_are_decided_once_and_marked(spark):
    rows = requests(120)
    got = decided(spark, rows, lambda r: by_time(3)(r)[::-1])
    assert sorted((r.request_id, r.ts.replace(tzinfo=None)) for r in got) == sorted((r[2], r[1]) for r in plain_decisions(rows, 900.0))
    assert any(r.late for r in got) and not all(r.late for r in got)


CALLS = "call_id string, lead string, created_on timestamp_ntz, duration_seconds int, conversation_type string, flag string, salesperson string"


def test_the_refresh_knows_what_has_come_and_survives_a_retry(spark, tmp_path):
    rng = random.Random(3)
    kinds = ["sales", "unusable", "unusable", "enrollment_or_payment", "brief_followup"]
    rows = [(f"C{i}", str(rng.randrange(25)), START + dt.timedelta(hours=rng.randrange(900)), 60, rng.choice(kinds), "Yes" if rng.random() < 0.03 else "No", "x") for i in range(150)]
    calls = lambda some: spark.createDataFrame(some, CALLS)
    codings = spark.createDataFrame([(str(i), "open" if i % 3 else "none", False, None, "in_target", None, "d", None, None, False) for i in range(25)],
                                    "lead string, stance string, status_needed boolean, status_reason string, target_value string, target_reason string, detail string, condition string, "
                                    "condition_can_be_met string, refused_after_commitment boolean").withColumn("condition_reason", F.lit(None).cast("string"))
    shown = ["lead", "category", "reason", "days_since"]
    for part in ([rows[:60]], [rows[:60], rows[60:110], rows[110:]]):
        seen = calls([r for p in part for r in p])
        got, state = refresh.run([calls(p) for p in part], codings, buckets=8)
        want = wl.graded(codings, seen).select(shown)
        assert sorted(map(tuple, got.select(shown).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    before = sorted(map(tuple, state.journeys().select("lead", "calls", "live_call_id", "attempts_since").collect()))
    state.append(calls(rows[110:]), 2)  # the last batch once more
    assert sorted(map(tuple, state.journeys().select("lead", "calls", "live_call_id", "attempts_since").collect())) == before
    want = outcomes(calls(rows)).join(last_live(calls(rows)), "lead").select("lead", "calls", "live_call_id", "attempts_since")
    assert sorted(map(tuple, want.collect())) == before
