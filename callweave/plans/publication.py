"""Publication in two phases: every table is computed and staged once, its guards are counted in the same pass, and nothing counts as published
before a manifest names it. A run is refused while codings have problems or are missing, when the rule is not the frozen one, or when held-out leads
were coded before the freeze; a refused or interrupted run leaves the last publication as it was."""

import hashlib
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.keys import dataset_digest, row_digest
from ..functions.rules import CATEGORIES, RULE
from ..operators import state
from ..operators.guards import raise_on
from ..operators.redact import possible_names
from ..operators.small import beside, case_of, constants
from ..session import keep, settle
from ..sources.sinks import safe_table
from . import worklist as wl

FREEZE = "rule_hash string, frozen_at string, first_frozen_at string, as_of string, selection_hash string, reason string"
MANIFEST = "name string, rows bigint, path string, published_at string, run string"


def rule_hash(rule=RULE):
    """Digest of the rule's settings and of the categories in their order."""
    return hashlib.sha256(json.dumps([rule, CATEGORIES], sort_keys=True).encode()).hexdigest()


def _versions(spark, folder):
    """All freezes so far, or None."""
    try:
        return spark.read.schema(FREEZE + ", version int").json(f"{folder}/freeze")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def freeze(spark, folder, as_of, selection, coded_holdout, now, reason=None, rule=RULE):
    """Fix rule, cutoff and selection; returns the record. The first freeze is refused once held-out leads are coded; a later version needs a reason, and
    earlier ones stay as history. `selection` has the leads, `coded_holdout` the held-out leads with a coding."""
    held = _versions(spark, folder)
    last = held and held.agg(F.max("version"), F.min("first_frozen_at")).first()
    if last and not reason:
        raise ValueError("The worklist rule is already frozen; a new version needs a reason")
    if not last:
        raise_on(coded_holdout.select("lead"), "Held-out leads were coded before the freeze")
    picked = dataset_digest(selection.select("lead")).first()["sha256"]
    record = (rule_hash(rule), now, last[1] if last else now, as_of, picked, reason or "")
    version = last[0] + 1 if last else 0
    constants(spark, [record], FREEZE).coalesce(1).write.mode("errorifexists").json(f"{folder}/freeze/version={version}")
    return frozen(spark, folder, rule)


def frozen(spark, folder, rule=RULE):
    """The record in force; refused if there is none or the rule in code has moved away from it."""
    held = _versions(spark, folder)
    if held is None:
        raise ValueError("Freeze the rule first")
    record = held.orderBy(F.desc("version")).first()
    if record["rule_hash"] != rule_hash(rule):
        raise ValueError("The rule in code differs from the frozen rule; freeze a new version")
    return record


def freeze_history(spark, folder):
    """Superseded freezes, each with the reason of the one after it."""
    held = _versions(spark, folder)
    after = held.select((F.col("version") - 1).alias("version"), F.col("reason").alias("superseded_reason"))
    return held.drop("reason").join(after, "version").select("version", "rule_hash", "frozen_at", "as_of", "superseded_reason")


def call_rows(calls, summaries, objections, actions):
    """Published call rows with the call's objections and next step. `objections` has call_id, item_pos, label, text and resolution; a call has at most
    twelve by its schema. `actions` has call_id and next_action."""
    how = F.coalesce(case_of(F.col("resolution"), wl.RESOLUTION_LABEL), F.col("resolution"), F.lit("unclear"))
    line = F.concat(tx.human_label(F.col("label")), F.lit(" ("), how, F.lit("): "), "text")
    said = objections.groupBy("call_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item_pos", line.alias("line")))), lambda x: x["line"]), "\n").alias("objections"))
    rows = wl.call_rows(calls, summaries).join(said, "call_id", "left").join(actions.select("call_id", F.coalesce("next_action", F.lit("")).alias("next_step")), "call_id", "left")
    return rows.withColumns({"objections": F.coalesce("objections", F.lit("None")), "next_step": F.coalesce("next_step", F.lit(""))})


def internal_rows(rows, holdout, pilot):
    """What the team keeps of each published lead: category, coder, whether it was held out, where it came from, digest of its coding."""
    marked = rows.join(holdout.select("lead", F.lit(True).alias("holdout")), "lead", "left").join(pilot.select("lead", F.lit("pilot").alias("source")), "lead", "left")
    return marked.select("lead", "category", "reason", "coder", F.coalesce("holdout", F.lit(False)).alias("holdout"), F.coalesce("source", F.lit("non-buyer sample")).alias("source"),
                         row_digest(rows, ["lead", "stance", "detail", "next_action"]).alias("coding_hash"))


def _match(df):
    """The first internal or gendered wording of a row, as `column: match`."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name not in ("lead", "call_id")]
    hits = [F.concat(F.lit(f"{c}: "), F.coalesce(*[tx.found(F.col(c), p) for p in (tx.INTERNAL_TEXT, tx.PRONOUNS)])) for c in texts]
    return F.coalesce(*hits) if hits else F.lit(None).cast("string")


def stage(tables, folder, run, guarded):
    """Write every table once; returns {name: (rows, first guarded wording or None)} as observed while writing."""
    seen = {}
    for name, df in tables.items():
        watch = Observation(name)
        match = _match(df) if name in guarded else F.lit(None).cast("string")
        df.observe(watch, F.count(F.lit(1)).alias("rows"), F.min(match).alias("match")).write.parquet(f"{folder}/stage/{run}/{name}")
        seen[name] = watch.get["rows"], watch.get["match"]
    return seen


def publish(spark, tables, folder, record, refusals, now, guarded=("journeys", "calls"), client=("worklist", "journeys", "calls", "meta")):
    """Stage, check, write the client files from the staged tables, then commit. `refusals` maps a message to a frame that must be empty."""
    for what, frame in refusals.items():
        raise_on(frame, what)
    run = uuid.uuid4().hex
    seen = stage(tables, folder, run, guarded)
    found = {name: match for name, (_, match) in seen.items() if match}
    if found:
        raise ValueError(f"Published text has internal wording; fix the cleaning rules: {found}")
    for name in client:
        df = spark.read.parquet(f"{folder}/stage/{run}/{name}")
        df.write.json(f"{folder}/client/{run}/{name}.json")
        safe_table(df).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(f"{folder}/client/{run}/{name}.csv")
    entries = [(name, rows, f"{folder}/stage/{run}/{name}", now, run) for name, (rows, _) in seen.items()]
    constants(spark, entries, MANIFEST).coalesce(1).write.mode("append").json(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark, folder):
    """The tables of the last committed publication."""
    held = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    last = held.agg(F.max_by("run", F.struct("published_at", "run")).alias("run"))
    return held.join(F.broadcast(last), "run", "left_semi")


def published(spark, folder, name):
    """A table of the last committed publication."""
    return spark.read.parquet(manifest(spark, folder).where(F.col("name") == name).first()["path"])


def tables_of(codings, calls, evidence, summaries, prior, audit, objections, actions, holdout, pilot, record, past_evidence, timing, signed=None):
    """Everything one publication writes, client and internal. Graded rows, the signed sheet and the client's texts are computed once: the texts are
    staged, and scanned for names in two ways."""
    rows = settle(wl.graded(codings, calls, cutoff=constants(codings.sparkSession, [(record["as_of"],)], "as_of string").select(F.to_date("as_of").alias("as_of"))))
    sheet = settle(wl.review_sheet(wl.review_claims(rows, evidence), prior))
    confirmed = wl.confirmed_leads(sheet) if signed is None else signed
    worklist, journeys = keep(wl.worklist_rows(rows, evidence, calls, confirmed), "worklist"), keep(wl.journey_rows(calls, summaries), "journeys")
    shown = keep(call_rows(calls, summaries, objections, actions).drop("created_on", "call_id"), "calls")
    status = wl.review_status(sheet)
    figures = beside(rows.agg(F.count(F.lit(1)).alias("leads")), calls.agg(F.countDistinct("lead").alias("journeys"), F.count(F.lit(1)).alias("calls")))
    meta = beside(beside(figures, status), audit.select(F.col("complete").alias("audit_complete"), "audit_reviewed"))
    meta = meta.withColumns({"review_draft": ~(F.col("complete") & F.col("audit_complete")), "as_of": F.lit(record["as_of"]), "rule_hash": F.lit(record["rule_hash"]),
                             "frozen_at": F.lit(record["frozen_at"]), "first_frozen_at": F.lit(record["first_frozen_at"])}).withColumnRenamed("complete", "claims_complete")
    words = [df.select(F.concat_ws(" ", *[F.col(f.name) for f in df.schema.fields if f.dataType.simpleString() == "string"]).alias("text")) for df in (worklist, journeys, shown)]
    return {"worklist": worklist, "journeys": journeys, "calls": shown, "meta": meta, "categories": wl.category_counts(rows), "review": sheet,
            "internal": internal_rows(rows, holdout, pilot), "evidence": past_evidence, "timing": timing,
            "possible_names": possible_names(words[0].unionByName(words[1]).unionByName(words[2]))}


def early_coded(codings_at, holdout, record):
    """Held-out leads coded before the first freeze. `codings_at` has lead and coded_at (text in ISO form)."""
    return state.coded_early(codings_at, holdout, record["first_frozen_at"])
