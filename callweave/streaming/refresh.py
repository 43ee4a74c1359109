"""Daily increments: what each batch of new calls says about its leads is appended to a state, and the worklist is graded from the state of
all batches seen so far. Old calls are never read again.

The state of a batch is one row per lead that can be merged in any order (counts, flags, purchase boundary, last live call, last day), and
the attempts after the batch's last live call. Every table of a batch is overwritten as a whole when the batch is run again, so a
retry gives the same state."""

from pyspark.sql import functions as F

from ..operators.journeys import POST, is_yes, moment
from ..plans import worklist as wl
from ..session import work_folder
from .late import feed

WORKLIST = "lead string, category string, reason string, days_since int, as_of string, bucket int"


def facts(calls):
    """One mergeable row per lead of a batch."""
    return calls.groupBy("lead").agg(
        F.count(F.lit(1)).alias("calls"), F.some(is_yes()).alias("any_yes"), F.every(is_yes()).alias("all_yes"), F.max("created_on").alias("last_call"),
        F.min(F.when(F.col("conversation_type").isin(*POST), moment())).alias("boundary"),
        F.max(F.when(F.col("conversation_type") != "unusable", moment())).alias("live"))


def attempts(calls, held):
    """Calls after the batch's last live call of their lead (all of them if it has none): no other can come after the last one of all."""
    joined = calls.select("lead", moment().alias("at")).join(held.select("lead", "live"), "lead")
    return joined.filter(F.col("live").isNull() | (F.col("at") > F.col("live"))).select("lead", "at")


def merged(held):
    """The facts of several batches as one row per lead."""
    return held.groupBy("lead").agg(F.sum("calls").alias("calls"), F.some("any_yes").alias("any_yes"), F.every("all_yes").alias("all_yes"),
                                    F.max("last_call").alias("last_call"), F.min("boundary").alias("boundary"), F.max("live").alias("live"))


class JourneyState:
    """The state's tables under a folder."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def append(self, calls, batch):
        held = facts(calls)
        held.write.mode("overwrite").parquet(f"{self.folder}/facts/batch={batch}")
        attempts(calls, self.table("facts").where(F.col("batch") == batch)).write.mode("overwrite").parquet(f"{self.folder}/attempts/batch={batch}")

    def table(self, name):
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def as_of(self):
        """The day of the last call seen, as a one-row frame."""
        return self.table("facts").agg(F.to_date(F.max("last_call")).alias("as_of"))

    def journeys(self, keep=lambda df: df):
        """(lead, calls, any_yes, all_yes, boundary, live, live_call_id, live_at, attempts_since) of all batches, for the leads that `keep` leaves."""
        now = merged(keep(self.table("facts")).drop("batch"))
        after = (keep(self.table("attempts")).join(now.select("lead", "live"), "lead").filter(F.col("live").isNull() | (F.col("at") > F.col("live")))
                 .groupBy("lead").agg(F.count(F.lit(1)).alias("attempts_since")))
        return now.join(after, "lead", "left").withColumns({"attempts_since": F.coalesce("attempts_since", F.lit(0)), "live_call_id": F.col("live.call_id"),
                                                           "live_at": F.col("live.created_on")})


def bucket(buckets):
    return F.pmod(F.hash("lead"), F.lit(buckets))


def regrade(state, hit, codings, out, buckets):
    """Grade the leads of the hit buckets from the state and replace just those partitions. A row without lead keeps a bucket's partition in
    being when its last lead has left the worklist."""
    spark = state.spark
    keep = lambda df: df.withColumn("bucket", bucket(buckets)).join(F.broadcast(hit), "bucket", "left_semi").drop("bucket")
    now = state.journeys(keep)
    rows = wl.graded_from(keep(codings), now.select("lead", "live_call_id", "live_at", "attempts_since"), now, state.as_of())
    rows = rows.select("lead", "category", "reason", "days_since", F.col("as_of").cast("string").alias("as_of"), bucket(buckets).alias("bucket"))
    blank = spark.createDataFrame([], WORKLIST).select("lead", "category", "reason", "days_since", "as_of")
    held = hit.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in blank.schema], "bucket")
    (rows.unionByName(held).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(out))


def run(parts, codings, buckets=64):
    """Take the parts of a call export one after another. A batch of a new day changes every lead's age and grades all buckets; any other
    grades the buckets of its leads. Returns (worklist, state) after the last part."""
    spark = codings.sparkSession
    folder = work_folder(spark, "refresh")
    state = JourneyState(spark, f"{folder}/journeys")
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))

    def each(batch, number):
        before = state.as_of().first()[0] if number else None
        state.append(batch, number)
        hit = every if state.as_of().first()[0] != before else batch.select(bucket(buckets).alias("bucket")).distinct()  # at most `buckets` rows
        regrade(state, hit, codings, f"{folder}/out", buckets)

    feed(parts, folder, lambda stream: stream.writeStream.foreachBatch(each))
    return spark.read.schema(WORKLIST).parquet(f"{folder}/out").where("lead is not null").drop("bucket"), state
