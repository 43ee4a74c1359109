"""Streams over the event ledger: costs per window, replays, and call bursts."""

from pyspark.sql import functions as F

from ..session import work_folder


def daily_costs(events, delay="1 day", width="1 day"):
    """Cost and failures per stage and tumbling window; events later than the watermark are dropped."""
    rows = events.withColumn("at", F.col("recorded_at").cast("timestamp")).withWatermark("at", delay)
    grouped = rows.groupBy(F.window("at", width), "stage").agg(
        F.count(F.lit(1)).alias("events"), F.sum("external_cost_inr").alias("cost_inr"), F.count_if(F.col("status") == "failed").alias("failures"))
    return grouped.select(F.col("window.start").alias("start_at"), F.col("window.end").alias("end_at"), "stage", "events", "cost_inr", "failures")


def without_replays(events, delay="2 days"):
    """Each event once, although its file may have been written twice; state lasts as long as the watermark."""
    rows = events.withColumn("at", F.col("recorded_at").cast("timestamp")).withWatermark("at", delay)
    return rows.dropDuplicatesWithinWatermark(["event_id"])


def call_bursts(events, gap="30 minutes", delay="1 hour"):
    """Sessions of events per call key with no pause longer than `gap`."""
    rows = events.withColumn("at", F.col("recorded_at").cast("timestamp")).withWatermark("at", delay)
    grouped = rows.groupBy(F.session_window("at", gap), "call_id").agg(F.count(F.lit(1)).alias("events"))
    return grouped.select("call_id", F.col("session_window.start").alias("start_at"), F.col("session_window.end").alias("end_at"), "events")


def drain(stream, name, mode="append"):
    """Run a stream over everything available to Parquet and read the result. Offsets and state are on shared storage, so
    a restarted job goes on where it stopped."""
    spark = stream.sparkSession
    folder = work_folder(spark, name)
    writer = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
    writer.start(f"{folder}/out").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
