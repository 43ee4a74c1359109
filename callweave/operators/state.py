"""Identity chains, freshness, incremental work, drift, attempts and budget."""

from pyspark.sql import functions as F

from ..functions.keys import digest
from .ranking import prefix_scan


def freshness(audio, artifacts, versions):
    """current / stale / missing per (call, stage) along a chain of stages.

    `audio` has call_id and sha256; `artifacts` call_id, stage, fingerprint; `versions` is an ordered list of
    (stage, method version). A stage's expected fingerprint digests the one before it and its own version, so a stale link
    makes every later link stale. One aggregate turns the artifacts into one row per call; nothing else is shuffled."""
    stages = [s for s, _ in versions]
    wide = artifacts.groupBy("call_id").agg(*[F.max(F.when(F.col("stage") == s, F.col("fingerprint"))).alias(s) for s in stages])
    rows = audio.join(wide, "call_id", "left")
    state, previous, sound = {}, F.col("sha256"), F.lit(True)
    for stage, version in versions:
        expected = digest(previous, version)
        matches = F.coalesce(F.col(stage) == expected, F.lit(False)) & sound
        state[stage] = F.when(F.col(stage).isNull(), "missing").when(matches, "current").otherwise("stale")
        previous, sound = expected, matches
    cells = F.array(*[F.struct(F.lit(s).alias("stage"), v.alias("state")) for s, v in state.items()])
    return rows.select("call_id", F.inline(cells))


def todo(inputs, artifacts):
    """Inputs (key, fingerprint) that have no artifact with that fingerprint yet."""
    return inputs.join(artifacts.select("call_id", "fingerprint"), ["call_id", "fingerprint"], "left_anti")


def source_of(calls, consensus, labelled):
    """Each call's transcript source: its consensus, else its labelled transcript, else none."""
    rows = calls.select("call_id").join(consensus.select("call_id", F.col("fingerprint").alias("c")), "call_id", "left").join(
        labelled.select("call_id", F.col("fingerprint").alias("l")), "call_id", "left")
    return rows.select("call_id", F.coalesce("c", "l").alias("fingerprint"),
                       F.when(F.col("c").isNotNull(), "consensus").when(F.col("l").isNotNull(), "labelled").otherwise("missing").alias("source"))


def status_counts(states):
    """Artifacts per stage and state."""
    return states.groupBy("stage", "state").agg(F.count(F.lit(1)).alias("calls"))


def drift(digests, manifest):
    """Published datasets whose digest differs from the manifest's (or which it lacks). Both have name and sha256."""
    joined = digests.join(manifest.select("name", F.col("sha256").alias("frozen")), "name", "full_outer")
    return joined.filter(~F.col("sha256").eqNullSafe(F.col("frozen")))


def supersede(manifest, history, changed, stamp, reason):
    """(new manifest, longer history): changed rows replace their entry; the old entry is kept with the reason."""
    if not reason:
        raise ValueError("A frozen entry is replaced only with a reason")
    old = manifest.join(changed.select("name"), "name", "left_semi").withColumns({"superseded_at": F.lit(stamp), "reason": F.lit(reason)})
    kept = manifest.join(changed.select("name"), "name", "left_anti")
    grown = old if history is None else history.unionByName(old)
    return kept.unionByName(changed.select(*manifest.columns)), grown


def coded_early(codings, holdout, frozen_at):
    """Held-out leads coded before the rule was frozen."""
    return codings.join(holdout.select("lead"), "lead", "left_semi").filter(F.col("coded_at") < F.lit(frozen_at))


def attempts(ledger, key="call_id"):
    """Per item and stage: attempts, failures, last status and whether it was retried."""
    return ledger.groupBy(key, "stage").agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("status") == "failed").alias("failures"),
                                            F.max_by("status", F.struct("recorded_at", "event_id")).alias("last_status"),
                                            F.sum("external_cost_inr").alias("cost_inr")).withColumn("retried", F.col("attempts") > 1)


def budget_running(requests, cap, ceiling=15000.0):
    """Committed total after each recorded request per budget, in time order, and whether it passes the cap. Refused
    requests were never recorded, so a running sum is the audit. Day buckets keep a busy budget out of one task."""
    rows = prefix_scan(requests, ["budget_id"], ["ts", "event_id"], F.to_date("ts"), F.col("final_inr"), "committed_inr")
    return rows.drop("__total").withColumn("over_cap", F.col("committed_inr") > min(cap, ceiling))


def budget_breach(running):
    """First request per budget that took it over the cap."""
    return running.filter("over_cap").groupBy("budget_id").agg(F.min_by("request_id", F.struct("ts", "event_id")).alias("request_id"), F.min("ts").alias("ts"))


def committed(requests):
    """Committed and in-flight money per budget."""
    return requests.groupBy("budget_id").agg(F.sum("final_inr").alias("committed_inr"),
                                             F.sum(F.when(F.col("final_status") == "reserved", F.col("final_inr")).otherwise(0.0)).alias("in_flight_inr"),
                                             F.count_if(F.col("final_status") == "uncertain_reserve_retained").alias("uncertain"))
