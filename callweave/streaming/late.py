"""Streams that lose no late row: what comes after its window was closed is published as a row of its own, and totals can be settled with it.

Windows and sessions are kept in a state store and closed by event-time timers, once the watermark has passed them. The event time that
drives the watermark is not handed to the stateful operator, as Spark would then drop late rows before it. A row without event_id only
moves the watermark.
"""

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.ranking import neighbour, positions, prefix_scan
from ..session import setting, work_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOWS = "kind string, stage string, start_us long, events long, cost_inr double, failures long, event_id long, at_us long"
SESSIONS = "kind string, call_id string, start_us long, end_us long, events long, event_id long"
# A window's rows are summed in so many parts, so that a busy stage is no single key.
PARTS = 8
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
# Counting a store's rows reads the whole list of a key again at every row appended to it.
UNCOUNTED = ("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")


class WindowTotals(StatefulProcessor):
    """Sums of one part of one window. Rows that come when the watermark has passed the window's end are published one by one."""

    def __init__(self, width_us):
        self.width_us = width_us

    def init(self, handle):
        self.handle = handle
        self.sums = handle.getValueState("sums", "events long, cost_inr double, failures long")

    def handleInputRows(self, key, rows, timerValues):
        stage, start_us, _ = key
        end_ms = (start_us + self.width_us) // 1000
        closed = end_ms < timerValues.getCurrentWatermarkInMs()
        held = self.sums.get() if self.sums.exists() else None
        events, cost, failures = held or (0, 0.0, 0)
        for pdf in rows:
            pdf = pdf[pdf["event_id"].notna()]  # without the rows that only move the watermark
            if closed:
                yield pd.DataFrame({"kind": "late", "stage": stage, "start_us": start_us, "events": 1, "cost_inr": pdf["cost_inr"].to_numpy(),
                                    "failures": pdf["failed"].to_numpy(), "event_id": pdf["event_id"].to_numpy(), "at_us": pdf["at_us"].to_numpy()})
            else:
                events, cost, failures = events + len(pdf), cost + float(pdf["cost_inr"].sum()), failures + int(pdf["failed"].sum())
        if not closed and events:
            self.sums.update((events, cost, failures))
            if not held:
                self.handle.registerTimer(end_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.sums.exists():
            events, cost, failures = self.sums.get()
            self.sums.clear()
            yield pd.DataFrame([("window", key[0], key[1], events, cost, failures, None, None)], columns=WINDOW_COLUMNS)

    def close(self):
        pass


WINDOW_COLUMNS = [c.split()[0] for c in WINDOWS.split(", ")]
SESSION_COLUMNS = [c.split()[0] for c in SESSIONS.split(", ")]


class Sessions(StatefulProcessor):
    """Open sessions of one call as (start, end, events). A row that touches none of them and whose own session the watermark has passed is
    published by itself."""

    def __init__(self, gap_us):
        self.gap_us = gap_us

    def init(self, handle):
        self.handle = handle
        self.open = handle.getListState("open", "start_us long, end_us long, events long")

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held = [tuple(r) for r in self.open.get()] if self.open.exists() else []
        late = []
        for pdf in rows:
            pdf = pdf[pdf["event_id"].notna()].sort_values("at_us")
            for at, event_id in zip(pdf["at_us"].tolist(), pdf["event_id"].tolist()):
                start, end, events = at, at + self.gap_us, 1
                touched = [s for s in held if s[0] < end and start < s[1]]
                if not touched and end < mark:
                    late.append(("late", key[0], start, end, 1, int(event_id)))
                    continue
                for s in touched:
                    held.remove(s)
                    start, end, events = min(start, s[0]), max(end, s[1]), events + s[2]
                held.append((start, end, events))
        self.keep(held)
        if late:
            yield pd.DataFrame(late, columns=SESSION_COLUMNS)

    def keep(self, held):
        if held:
            self.open.put(held)
            self.handle.registerTimer(min(s[1] for s in held) // 1000)
        else:
            self.open.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs()
        held = [tuple(r) for r in self.open.get()] if self.open.exists() else []
        over = [s for s in held if s[1] // 1000 < mark]
        if over:
            self.keep([s for s in held if s[1] // 1000 >= mark])
            yield pd.DataFrame([("session", key[0], *s, None) for s in over], columns=SESSION_COLUMNS)

    def close(self):
        pass


def _marked(events, delay):
    """Rows with at_us, under a watermark on a column that later steps no longer have."""
    at = F.col("recorded_at").cast("timestamp")
    return events.withColumns({"__at": at, "at_us": F.unix_micros(at)}).withWatermark("__at", delay)


def window_ledger(events, delay="1 day", width_us=86_400_000_000):
    """Closed windows per stage (kind `window`) and the rows that came after (kind `late`)."""
    rows = _marked(events, delay).select(
        "stage", (F.col("at_us") - F.pmod("at_us", F.lit(width_us))).alias("start_us"), F.pmod(F.hash("event_id"), F.lit(PARTS)).alias("part"), "event_id", "at_us",
        F.col("external_cost_inr").alias("cost_inr"), F.when(F.col("status") == "failed", 1).otherwise(0).cast("long").alias("failed"))
    return rows.groupBy("stage", "start_us", "part").transformWithStateInPandas(WindowTotals(width_us), WINDOWS, "Append", "EventTime")


def settled_windows(rows, width_us=86_400_000_000):
    """Totals per window and stage, late rows included, and how many of them there were."""
    sums = rows.groupBy("stage", "start_us").agg(F.sum("events").alias("events"), F.sum("cost_inr").alias("cost_inr"), F.sum("failures").alias("failures"),
                                                 F.count_if(F.col("kind") == "late").alias("late_events"))
    return sums.select(F.timestamp_micros("start_us").alias("start_at"), F.timestamp_micros(F.col("start_us") + width_us).alias("end_at"), "stage",
                       "events", "cost_inr", "failures", "late_events")


def session_ledger(events, delay="1 hour", gap_us=1_800_000_000):
    """Closed sessions per call (kind `session`) and the rows that came after (kind `late`)."""
    rows = _marked(events, delay).select("call_id", "event_id", "at_us")
    return rows.groupBy("call_id").transformWithStateInPandas(Sessions(gap_us), SESSIONS, "Append", "EventTime")


def settled_sessions(rows):
    """Sessions with late rows put in: a late row may lengthen a session or join two."""
    order, day = ["start_us", "end_us", "events"], F.expr("start_us div 86400000000")
    rows = rows.select("call_id", *order)
    placed = positions(prefix_scan(rows, ["call_id"], order, day, F.col("end_us"), "reach", "max"), ["call_id"], [*order, "reach"], day, "place")
    placed = neighbour(placed, ["call_id"], "place", ["reach"], -1, "before_")
    opens = F.when(F.col("start_us") < F.col("before_reach"), 0).otherwise(1)
    numbered = prefix_scan(placed, ["call_id"], ["place"], day, opens, "session")
    grouped = numbered.groupBy("call_id", "session").agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("events").alias("events"))
    return grouped.select("call_id", F.timestamp_micros("start_us").alias("start_at"), F.timestamp_micros("end_us").alias("end_at"), "events")


def feed(parts, folder, start):
    """Parts arrive one after another: each is added to the input folder, and `start(stream)` gives a writer that is run anew on the same
    checkpoint until it has taken it, as a daily job would."""
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        stream = part.sparkSession.readStream.schema(part.schema).parquet(f"{folder}/in")
        start(stream).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()


def drain_parts(parts, build, name):
    """The rows that the stream `build(input)` writes for all parts."""
    spark = parts[0].sparkSession
    folder = work_folder(spark, name)
    schema = []

    def start(stream):
        out = build(stream)
        schema[:] = [out.schema]
        return out.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")

    with setting(spark, *STORE), setting(spark, *UNCOUNTED):
        feed(parts, folder, start)
    return spark.read.schema(schema[0]).parquet(f"{folder}/out")


def end_of_export(rows, at, days=400):
    """One row with nothing but a far later time: it moves the watermark past everything that is open."""
    last = rows.agg((F.max(at) + F.expr(f"interval {days} days")).alias(at))
    return last.select(*[F.col(at).cast(f.dataType).alias(at) if f.name == at else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
