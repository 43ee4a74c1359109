"""Reproducible samples of whole journeys, by hash order. Leads are chosen on a lead-level frame; calls follow by semi-join."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.keys import digest
from .journeys import OUTCOME_ALL_YES, OUTCOME_MIXED, number_calls, outcomes
from .ranking import hash_rank
from .small import constants

# ---- fixed values: journey lengths and how many leads of each, group aliases ----
DEFAULT_QUOTAS = {2: 5, 3: 5, 4: 5, 5: 7, 6: 8, 7: 6, 8: 5, 9: 4, 10: 3, 12: 2}
OPEN_SAMPLE_SIZE = 150
OPEN_MIN_SECONDS = 180
NO_CONVERSION = "No conversion recorded by the export date"
# ---- end of fixed values ----


def draw(leads, seed, k):
    """The k leads with the smallest digests of [seed, lead]; TakeOrdered keeps k rows per task."""
    return leads.select("lead", digest(seed, F.col("lead")).alias("draw_hash")).orderBy("draw_hash").limit(k)


def with_aliases(leads, prefix, seed, width=3):
    """Alias by hash order: L001, L002, ... The rank is exact over all leads and computed per hash bucket."""
    ranked = hash_rank(leads.withColumn("__h", digest(seed, F.col("lead"))), "__h", "__n")
    return ranked.withColumn("lead_alias", F.concat(F.lit(prefix), F.when(
        F.length(F.col("__n").cast("string")) >= width, F.col("__n").cast("string")).otherwise(
        F.lpad(F.col("__n").cast("string"), width, "0")))).drop("__h", "__n")


def _quotas(spark, quotas):
    return F.broadcast(constants(spark, [(int(k), int(v)) for k, v in quotas.items()], "calls bigint, quota bigint"))


def stratified(leads, seed, quotas, strict=True):
    """First `quota` leads of each journey length by hash. `leads` has lead and calls. A short stratum is an error; with
    strict=False it gives the leads there are."""
    if strict:
        check_quotas(leads, quotas)
    rows = leads.join(_quotas(leads.sparkSession, quotas), "calls").withColumn("draw_hash", digest(seed, F.col("lead")))
    window = Window.partitionBy("calls").orderBy("draw_hash")
    limit = max(quotas.values())  # lets Spark cut each task's rows before the shuffle
    return rows.withColumn("draw_rank", F.row_number().over(window)).filter(F.col("draw_rank") <= limit).filter(
        F.col("draw_rank") <= F.col("quota"))


def balanced(leads, seed, quotas, strict=True):
    """Stratified draw that takes outcomes in turn, prefers leads whose agents carry few calls, then hash order.
    `leads` has lead, calls, outcome and agent_load; strict as in `stratified`."""
    if strict:
        check_quotas(leads, quotas)
    rows = leads.join(_quotas(leads.sparkSession, quotas), "calls").withColumn("draw_hash", digest(seed, F.col("lead")))
    limit = max(quotas.values())
    turn = Window.partitionBy("calls", "outcome").orderBy("agent_load", "draw_hash")
    rows = rows.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= limit)
    pick = Window.partitionBy("calls").orderBy("turn", "outcome", "draw_hash")
    return rows.withColumn("draw_rank", F.row_number().over(pick)).filter(F.col("draw_rank") <= limit).filter(
        F.col("draw_rank") <= F.col("quota"))


def agent_load(calls):
    """Mean number of calls, over the whole table, of the agents a lead spoke to."""
    load = calls.groupBy("salesperson").agg(F.count(F.lit(1)).alias("load"))
    pairs = calls.select("lead", "salesperson").distinct()
    return pairs.join(load, "salesperson").groupBy("lead").agg(F.avg("load").alias("agent_load"))


def check_quotas(leads, quotas):
    """Raise when a stratum is short; nothing is ever dropped silently."""
    found = dict(leads.join(_quotas(leads.sparkSession, quotas), "calls", "right").groupBy("calls", "quota").agg(
        F.count("lead").alias("n")).filter(F.col("n") < F.col("quota")).select("calls", "n").collect())
    if found:
        short = "; ".join(f"Need {quotas[k]} leads with {k} calls; found {n}" for k, n in sorted(found.items()))
        raise ValueError(short + ". Adjust quotas explicitly.")


def holdout(leads, seed, step=5):
    """Every `step`-th lead in (journey length, hash) order is held out. Rank within the length by hash bucket, plus the
    number of leads with shorter journeys (one row per length)."""
    rows = leads.withColumn("__h", digest(seed, "qa", F.col("lead")))
    lengths = leads.groupBy("calls").agg(F.count(F.lit(1)).alias("__n"))
    shorter = lengths.select("calls", F.coalesce(F.sum("__n").over(
        Window.orderBy("calls").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__shorter"))
    ranked = hash_rank(rows, "__h", "__rank", strata=["calls"]).join(shorter, "calls")
    ranked = ranked.withColumn("holdout_rank", F.col("__shorter") + F.col("__rank"))
    return ranked.withColumn("split", F.when(F.col("holdout_rank") % step == 0, "holdout").otherwise("development")).drop(
        "__h", "__rank", "__shorter")


def customers(calls, pilot):
    """Leads outside the pilot whose every call is flagged Yes."""
    return outcomes(calls).filter("all_yes").join(pilot.select("lead"), "lead", "left_anti")


def open_pool(calls, pilot, min_seconds=OPEN_MIN_SECONDS):
    """Leads outside the pilot with no Yes on any call and a call of three minutes or more."""
    longest = calls.groupBy("lead").agg(F.max("duration_seconds").alias("longest_seconds"))
    pool = outcomes(calls).filter(~F.col("any_yes")).join(longest.filter(F.col("longest_seconds") >= min_seconds), "lead")
    return pool.join(pilot.select("lead"), "lead", "left_anti")


def archive(calls, *taken):
    """Leads in none of the given groups."""
    leads = outcomes(calls)
    for group in taken:
        leads = leads.join(group.select("lead"), "lead", "left_anti")
    return leads


def cohort_calls(calls, leads, name, prefix, width=3):
    """All calls of the chosen leads, numbered, with alias, split and outcome label."""
    label = F.when(F.col("all_yes"), OUTCOME_ALL_YES).when(~F.col("any_yes"), NO_CONVERSION).otherwise(OUTCOME_MIXED)
    chosen = with_aliases(leads.select("lead", "all_yes", "any_yes"), prefix, name, width).select(
        "lead", "lead_alias", label.alias("journey_outcome_label"))
    whole = calls.join(leads.select("lead"), "lead", "left_semi")
    return number_calls(whole).join(chosen, "lead").withColumn("split", F.lit(name))


def select_calls(calls, split=None, call_ids=None, limit=None):
    """Calls by split and ids, optionally the first `limit` in journey order. An id outside the split is an error."""
    if split:
        calls = calls.filter(F.col("split") == split)
    if call_ids is not None:
        unknown = sorted(r["call_id"] for r in missing_ids(calls, call_ids).limit(5).collect())
        if unknown:
            raise ValueError(f"Unknown call ids in this selection: {', '.join(unknown)}")
        calls = calls.join(call_ids, "call_id", "left_semi")
    return calls.orderBy("created_on", "call_id").limit(limit) if limit else calls


def missing_ids(calls, call_ids):
    return call_ids.join(calls, "call_id", "left_anti")


def selection_summary(selected):
    held = F.col("split") == "holdout"
    return selected.agg(F.count(F.lit(1)).alias("calls"), F.countDistinct("lead").alias("leads"),
                        (F.sum("duration_seconds") / 60).alias("audio_minutes"), F.count_if(held).alias("holdout_calls"),
                        F.countDistinct(F.when(held, F.col("lead"))).alias("holdout_leads"),
                        F.countDistinct("salesperson").alias("salespeople"))
