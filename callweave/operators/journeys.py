"""Lead journeys: order, boundaries, outcomes and roll-ups. Aggregates and equi-joins wherever a window is not needed."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .ranking import positions
from .small import beside

# ---- fixed values: call kinds and outcome labels ----
PRE = ("sales", "brief_followup")
POST = ("enrollment_or_payment", "learner_support", "administrative")
OUTCOME_ALL_YES = "CRM reported converted; unverified"
OUTCOME_MIXED = "Mixed CRM flags; unresolved"
OUTCOME_UNKNOWN = "Outcome unknown"
# ---- end of fixed values ----



def moment():
    """The journey order of a call as one comparable value."""
    return F.struct("created_on", "call_id")


def is_yes():
    """Null is unknown, never a No."""
    return F.coalesce(F.col("flag"), F.lit("")) == "Yes"


def number_calls(calls, number="call_number", size="journey_calls"):
    """Each call's place in its journey and the journey's length, exact for leads of any size (day buckets)."""
    return positions(calls, ["lead"], ["created_on", "call_id"], F.to_date("created_on"), number, size)


def outcomes(calls):
    """One row per lead: label over the set of its flags."""
    grouped = calls.groupBy("lead").agg(F.every(is_yes()).alias("all_yes"), F.some(is_yes()).alias("any_yes"),
                                        F.count(F.lit(1)).alias("calls"))
    return grouped.withColumn("outcome", F.when(F.col("all_yes"), OUTCOME_ALL_YES).when(F.col("any_yes"), OUTCOME_MIXED)
                              .otherwise(OUTCOME_UNKNOWN))


def crm_status(all_yes, any_yes, labels=("Customer (CRM)", "Unclear: mixed CRM flags", "Open lead")):
    return F.when(all_yes, labels[0]).when(any_yes, labels[1]).otherwise(labels[2])


def eligible(calls, min_seconds=180):
    """Leads with at least one call of the given length."""
    return calls.groupBy("lead").agg(F.max("duration_seconds").alias("longest_seconds")).filter(F.col("longest_seconds") >= min_seconds)


def purchase_boundary(calls):
    """First purchase or service call of each lead that has one."""
    return (calls.filter(F.col("conversation_type").isin(*POST)).groupBy("lead").agg(F.min(moment()).alias("boundary")))


def pre_purchase(calls):
    """Sales and follow-up calls before the lead's first purchase or service call.

    The boundary is an aggregate (combined map-side) joined back by lead, so a hot lead is a skewed join, which Spark
    splits, and not one huge window partition."""
    marked = calls.filter(F.col("conversation_type").isin(*PRE)).join(purchase_boundary(calls), "lead", "left")
    return marked.filter(F.col("boundary").isNull() | (moment() < F.col("boundary"))).drop("boundary")


def last_live(calls):
    """Per lead: the last call that reached a person, and how many calls came after it (all of them if none did)."""
    live = calls.filter(F.col("conversation_type") != "unusable").groupBy("lead").agg(F.max(moment()).alias("live"))
    joined = calls.select("lead", "created_on", "call_id").join(live, "lead", "left")
    after = F.col("live").isNull() | (moment() > F.col("live"))
    return joined.groupBy("lead").agg(F.max("live").alias("live"), F.count_if(after).alias("attempts_since")).select(
        "lead", F.col("live.call_id").alias("live_call_id"), F.col("live.created_on").alias("live_at"), "attempts_since")


def rollup(calls):
    """Journey figures per lead. The mean gap telescopes: (last - first) / (calls - 1)."""
    seconds = lambda c: F.unix_micros(c.cast("timestamp")) / 1e6
    first, last = F.min("created_on"), F.max("created_on")
    grouped = calls.groupBy("lead").agg(
        F.count(F.lit(1)).alias("calls"), (F.sum("duration_seconds") / 60).alias("minutes"), first.alias("first_call"),
        last.alias("last_call"), F.max("duration_seconds").alias("longest_seconds"),
        F.countDistinct("salesperson").alias("salespeople"), F.max_by("salesperson", moment()).alias("last_salesperson"))
    gap = (seconds(F.col("last_call")) - seconds(F.col("first_call"))) / 86400 / F.nullif(F.col("calls") - 1, F.lit(0))
    return grouped.withColumn("mean_gap_days", gap)


def buyer_lags(calls):
    """Days from a lead's last pre-purchase call to its first purchase or service call."""
    last_pre = pre_purchase(calls).groupBy("lead").agg(F.max("created_on").alias("pre_at"))
    return last_pre.join(purchase_boundary(calls), "lead").select(
        "lead", F.date_diff(F.to_date("boundary.created_on"), F.to_date("pre_at")).alias("lag_days"))


def upper_median(df, column, out):
    """Element n div 2 of the sorted values, from value counts: one row per distinct value, never a sorted list."""
    counts = df.groupBy(column).count()
    # Lags are whole days, so the distinct values are bounded by the calendar.
    running = counts.withColumn("upto", F.sum("count").over(Window.orderBy(column))).withColumn(
        "n", F.sum("count").over(Window.partitionBy()))
    return running.filter(F.col("upto") > F.floor(F.col("n") / 2)).agg(F.min(column).alias(out))


def buyer_timing(calls):
    """customers, upper-median lag and the shares within 45 and 90 days."""
    lags = buyer_lags(calls)
    shares = lags.agg(F.count(F.lit(1)).alias("customers"),
                      (F.count_if(F.col("lag_days") <= 45) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("within_45_share"),
                      (F.count_if(F.col("lag_days") <= 90) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("within_90_share"))
    return beside(shares, upper_median(lags, "lag_days", "median_days"))


def first_group(groups):
    """Calls of each lead from the first named group that has the lead: `groups` is a list of (name, calls)."""
    tagged = None
    for rank, (name, calls) in enumerate(groups):
        part = calls.withColumn("source_group", F.lit(name)).withColumn("__rank", F.lit(rank))
        tagged = part if tagged is None else tagged.unionByName(part)
    best = tagged.groupBy("lead").agg(F.min("__rank").alias("__best"))
    return tagged.join(best, "lead").filter(F.col("__rank") == F.col("__best")).drop("__rank", "__best")
