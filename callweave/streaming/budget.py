"""Budget enforcement as a stateful stream: whether a request is accepted depends on the ones accepted before it in event time."""

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values ----
CEILING_INR = 15000.0
OUTPUT = "budget_id string, request_id string, ts timestamp, decision string, committed_inr double, late boolean"
# Steps that wait are held in tables of up to so many; as many are decided and published at a time.
HELD = 100_000
# ---- end of fixed values ----

STEPS = pa.schema([("at_us", pa.int64()), ("later", pa.int32()), ("event_id", pa.int64()), ("request_id", pa.large_string()), ("status", pa.large_string()),
                   ("inr", pa.float64())])


def packed(steps):
    """A table of steps as bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, STEPS, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(steps)
    return sink.getvalue().to_pybytes()


def unpacked(tables):
    """The steps of packed tables as one."""
    return pa.concat_tables([STEPS.empty_table(), *(pa.ipc.open_stream(t).read_all() for t in tables)]).combine_chunks()


def in_order(steps):
    """The steps' numbers in event order."""
    return pc.sort_indices(steps, sort_keys=[(name, "ascending") for name in STEPS.names])


def decide(committed, held, step, status, inr, cap):
    """(decision, committed, held) after one step of a request; `held` is its open reservation or None.

    A reservation is refused when it would pass the cap. A close of usage replaces the reservation by the reported
    amount, a definite rejection releases it, and an uncertain end keeps it. Closes of unknown requests change nothing."""
    if step == "reserve":
        if committed + inr > cap:
            return "refused", committed, None
        return "accepted", committed + inr, inr
    if held is None:
        return "ignored", committed, None
    if status == "usage_reported":
        return "settled", committed + inr - held, None
    if status == "rejected_not_billed":
        return "released", committed - held, None
    return "kept", committed, None


class BudgetProcessor(StatefulProcessor):
    """State per budget id: the committed total, the open reservations and their number, and the steps that wait for the watermark, with one timer
    at the first of them. Steps are decided in event order once the watermark has passed them, whatever trigger brought them; one that comes after
    later ones were decided is decided at once and marked late. Only the steps between two watermarks are ever held, as packed tables: the state has
    a row per HELD steps, not one per step."""

    def __init__(self, cap):
        self.cap = cap

    def init(self, handle):
        self.handle = handle
        self.total = handle.getValueState("total", "inr double, decided_us long, open long")
        self.open = handle.getMapState("open", "request_id string", "inr double")
        self.waiting = handle.getListState("waiting", "first_us long, steps binary")
        self.timer = handle.getValueState("timer", "at_ms long")

    def decided(self, key, steps, order, late):
        """Decisions for the steps of the given numbers in their order, HELD at a time. Open reservations are read once: all together where the steps
        outnumber them, else one by one; those opened and closed among the steps never reach the state."""
        committed, upto, count = self.total.get() if self.total.exists() else (0.0, -1, 0)
        whole = count <= len(order)
        before = {k[0]: v[0] for k, v in self.open.iterator()} if whole and count else {}
        held = dict(before)
        for start in range(0, len(order), HELD):
            part = steps.take(order.slice(start, HELD))
            columns = [c.to_numpy() if pa.types.is_floating(c.type) or pa.types.is_integer(c.type) else c.to_pylist() for c in part.columns]
            at, later, _, requests, statuses, amounts = columns
            decisions, totals = [], []
            for closes, request_id, status, inr in zip(later.tolist(), requests, statuses, amounts.tolist()):
                if not whole and request_id not in before:
                    request = (request_id,)
                    before[request_id] = self.open.getValue(request)[0] if self.open.containsKey(request) else None
                    if before[request_id] is not None:
                        held[request_id] = before[request_id]
                reserved = held.get(request_id) if closes else None
                decision, committed, now = decide(committed, reserved, "close" if closes else "reserve", status, inr, self.cap)
                if now is not None:
                    held[request_id] = now
                elif reserved is not None:
                    del held[request_id]
                decisions.append(decision)
                totals.append(committed)
            upto = max(upto, int(at[-1]))
            if not whole:
                before = {r: was for r, was in before.items() if was is not None or r in held}
            yield pd.DataFrame({"budget_id": key[0], "request_id": requests, "ts": at.astype("datetime64[us]"), "decision": decisions, "committed_inr": totals, "late": late})
        for request_id, was in before.items():
            if was is not None and request_id not in held:
                self.open.removeKey((request_id,))
                count -= 1
        for request_id, now in held.items():
            was = before.get(request_id)
            if now != was:
                self.open.updateValue((request_id,), (now,))
                count += was is None
        self.total.update((committed, upto, count))

    def wake(self, at_ms):
        """One timer per key, at the first step that waits: every timer reads and sorts all of them."""
        held = self.timer.get()[0] if self.timer.exists() else None
        if held is None or at_ms < held:
            if held is not None:
                self.handle.deleteTimer(held)
            self.handle.registerTimer(at_ms)
            self.timer.update((at_ms,))

    def tables(self, rows):
        """The steps among the rows, HELD or more at a time."""
        some, n = [], 0
        for pdf in rows:
            pdf = pdf[pdf["event_id"].notna()]  # without rows that only move the watermark
            some, n = ([*some, pdf] if len(pdf) else some), n + len(pdf)
            if n >= HELD:
                yield self.table(some)
                some, n = [], 0
        if n:
            yield self.table(some)

    def table(self, frames):
        steps = pd.concat(frames).astype({"event_id": "int64"})
        return pa.Table.from_pandas(steps[STEPS.names], STEPS, preserve_index=False).combine_chunks()

    def keep_waiting(self, steps):
        """Rows of state for steps, and the first time among them."""
        first = pc.min(steps["at_us"]).as_py()
        return [(first, packed(steps))], first

    def handleInputRows(self, key, rows, timerValues):
        upto = self.total.get()[1] if self.total.exists() else -1
        first = None
        for steps in self.tables(rows):
            passed = pc.less(steps["at_us"], upto)
            late, waiting = steps.filter(passed), steps.filter(pc.invert(passed))
            if len(waiting):
                held, at = self.keep_waiting(waiting)
                self.waiting.appendList(held)
                first = min(at, first if first is not None else at)
            if len(late):
                yield from self.decided(key, late, in_order(late), True)
        if first is not None:
            self.wake(first // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        held = list(self.waiting.get()) if self.waiting.exists() else []
        over = [h for h in held if h[0] // 1000 < mark]  # tables with steps that are due
        kept = [h for h in held if h[0] // 1000 >= mark]
        steps = unpacked(h[1] for h in over)
        due = pc.less(steps["at_us"], mark * 1000)
        rest = steps.filter(pc.invert(due))
        if len(rest):
            kept += self.keep_waiting(rest)[0]
        steps = steps.filter(due)
        if len(steps) and kept:
            self.waiting.put([tuple(h) for h in kept])
        elif len(steps):
            self.waiting.clear()
        if kept:
            self.wake(min(h[0] for h in kept) // 1000)
        if len(steps):
            yield from self.decided(key, steps, in_order(steps), False)

    def close(self):
        pass


def steps(requests, hold="6 hours"):
    """Recorded requests as reserve and close events."""
    at = F.col("ts").cast("timestamp")
    reserve = F.struct(at.alias("ts"), F.lit("reserve").alias("step"), F.lit("reserved").alias("status"), F.col("reserve_inr").alias("inr"))
    close = F.struct((at + F.expr(f"interval {hold}")).alias("ts"), F.lit("close").alias("step"), F.col("final_status").alias("status"), F.col("final_inr").alias("inr"))
    cells = F.when(F.col("final_status") == "reserved", F.array(reserve)).otherwise(F.array(reserve, close))
    return requests.select("budget_id", "request_id", "event_id", F.inline(cells))


def enforce(events, cap, ceiling=CEILING_INR, delay="1 day"):
    """Decisions per request step, in event order. A configured cap may only lower the ceiling. `delay` covers the way from a reservation to
    its close, as both stand in one record."""
    if not 0 < cap < float("inf"):
        raise ValueError("The cap must be finite and positive")
    marked = events.withColumn("at_us", F.unix_micros("ts")).withWatermark("ts", delay)
    rows = marked.select("budget_id", "request_id", "event_id", "at_us", F.when(F.col("step") == "reserve", 0).otherwise(1).alias("later"), "status", "inr")
    return rows.groupBy("budget_id").transformWithStateInPandas(
        statefulProcessor=BudgetProcessor(min(cap, ceiling)), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
