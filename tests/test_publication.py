"""Publication: what is refused, what is kept, and that a refused run changes nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from callweave.plans import publication as pb

NOW, LATER = "2026-05-01T10:00:00", "2026-06-01T10:00:00"


@pytest.fixture
def leads(spark):
    return spark.createDataFrame([("1",), ("2",), ("3",)], "lead string")


def test_freeze_needs_a_reason_and_keeps_history(spark, leads, tmp_path):
    at = str(tmp_path)
    with pytest.raises(ValueError, match="Freeze the rule first"):
        pb.frozen(spark, at)
    with pytest.raises(ValueError, match="coded before the freeze"):
        pb.freeze(spark, at, "2026-04-30", leads, leads.limit(1), NOW)
    first = pb.freeze(spark, at, "2026-04-30", leads, leads.limit(0), NOW)
    with pytest.raises(ValueError, match="needs a reason"):
        pb.freeze(spark, at, "2026-04-30", leads, leads.limit(0), LATER)
    changed = dict(pb.RULE, hot_within_days=30)
    with pytest.raises(ValueError, match="differs from the frozen rule"):
        pb.frozen(spark, at, changed)
    # Later versions may come when held-out leads are coded; the first time stays.
    second = pb.freeze(spark, at, "2026-05-31", leads.limit(2), leads, LATER, "shorter window", changed)
    assert (second.frozen_at, second.first_frozen_at, second.as_of) == (LATER, NOW, "2026-05-31") and second.selection_hash != first.selection_hash
    assert pb.freeze_history(spark, at).collect()[0].asDict() == {"version": 0, "rule_hash": first.rule_hash, "frozen_at": NOW, "as_of": "2026-04-30", "superseded_reason": "shorter window"}


def tables(spark, text="a plain text", n=2):
    rows = spark.createDataFrame([(str(i), text) for i in range(n)], "lead string, summary string")
    return {"worklist": rows, "journeys": rows, "calls": rows, "meta": rows.agg(F.count("*").alias("leads")), "internal": rows}


def test_a_refused_run_leaves_the_last_publication(spark, leads, tmp_path):
    at = str(tmp_path)
    record = pb.freeze(spark, at, "2026-04-30", leads, leads.limit(0), NOW)
    none = spark.createDataFrame([], "lead string")
    pb.publish(spark, tables(spark), at, record, {"Coded leads fail the check": none}, NOW)
    want = {(r.name, r.rows) for r in pb.manifest(spark, at).collect()}
    assert want == {("worklist", 2), ("journeys", 2), ("calls", 2), ("meta", 1), ("internal", 2)}
    with pytest.raises(ValueError, match="Coded leads fail the check.*'7'"):
        pb.publish(spark, tables(spark, n=5), at, record, {"Coded leads fail the check": spark.createDataFrame([("7",)], "lead string")}, LATER)
    coded = spark.createDataFrame([("1", "2026-04-01T00:00:00"), ("2", "2026-05-02T00:00:00"), ("9", "2026-01-01")], "lead string, coded_at string")
    with pytest.raises(ValueError, match="coded early.*'1'"):
        pb.publish(spark, tables(spark, n=5), at, record, {"Held-out leads coded early": pb.early_coded(coded, leads, record)}, LATER)
    for text, found in (("the gemini text", "gemini"), ("wait for her", "her"), ("a course_fit case", "course_fit")):
        with pytest.raises(ValueError, match=f"summary: {found}"):
            pb.publish(spark, tables(spark, text, 5), at, record, {}, LATER)
    assert {(r.name, r.rows) for r in pb.manifest(spark, at).collect()} == want
    pb.publish(spark, tables(spark, n=3), at, record, {}, LATER)
    assert pb.published(spark, at, "internal").count() == 3 and {r.rows for r in pb.manifest(spark, at).collect()} == {3, 1}
    run = pb.manifest(spark, at).first().run
    assert spark.read.option("header", True).csv(f"{at}/client/{run}/calls.csv").count() == spark.read.json(f"{at}/client/{run}/calls.json").count() == 3


def test_each_table_is_computed_once(spark, leads, tmp_path):
    at, seen = str(tmp_path), spark.sparkContext.accumulator(0)
    record = pb.freeze(spark, at, "2026-04-30", leads, leads.limit(0), NOW)
    counted = F.udf(lambda x: (seen.add(1), x)[1], "string").asNondeterministic()
    rows = spark.createDataFrame([(str(i), "text") for i in range(4)], "lead string, summary string").withColumn("summary", counted("summary"))
    pb.publish(spark, tables(spark) | {"calls": rows}, at, record, {}, NOW)
    assert seen.value == 4


def test_call_rows_show_objections_and_next_step(spark):
    calls = spark.createDataFrame([("C1", "7", dt.datetime(2026, 4, 2, 9), 130, "sales"), ("C2", "7", dt.datetime(2026, 4, 3, 9), 10, "unusable")],
                                  "call_id string, lead string, created_on timestamp_ntz, duration_seconds int, conversation_type string")
    objections = spark.createDataFrame([("C1", "2", "course_fit", "too long", "partly_addressed"), ("C1", "1", "price", "dear", None), ("C1", "3", "time", "none", "not_addressed")],
                                       "call_id string, item_pos string, label string, text string, resolution string")
    rows = pb.call_rows(calls, spark.createDataFrame([("C1", "s")], "call_id string, summary string"), objections, spark.createDataFrame([("C1", None), ("C2", "Ring")], "call_id string, next_action string"))
    assert {r.call_id: (r.objections, r.next_step) for r in rows.collect()} == {
        "C1": ("Price (unclear): dear\nCourse fit (partly addressed): too long\nTime (not addressed): none", ""), "C2": ("None", "Ring")}


def test_a_bad_date_is_shown_reported_and_refused(spark, leads, tmp_path):
    from callweave.plans import worklist as wl
    evidence = spark.createDataFrame([("1", 1, "stance", "2026-02-30"), ("1", 2, "stance", "2026-02-28"), ("2", 3, "stance", None)], "lead string, evidence_no int, place string, date string")
    bad = wl.undated(evidence)
    assert sorted((r.lead, r.evidence_no) for r in bad.collect()) == [("1", 1), ("2", 3)]
    record = pb.freeze(spark, str(tmp_path), "2026-04-30", leads, leads.limit(0), NOW)
    with pytest.raises(ValueError, match="Citations without a date.*2026-02-30"):
        pb.publish(spark, tables(spark), str(tmp_path), record, {"Citations without a date": bad}, NOW)


def test_earlier_review_rows_stand_whole(spark):
    from callweave.plans import worklist as wl
    claims = spark.createDataFrame([("1", "Hot", "c", "2026-01-01", "00:10", "q"), ("2", "Warm", "c", "2026-01-01", "00:10", "q")], "lead string, category string, claim string, date string, timestamp string, quote string")
    prior = spark.createDataFrame([("1", "Warm", "c", "2025-12-01", "00:05", "q", "Confirmed", "n", "r", "2026-02-01"), ("1", "Cold", "c", "2025-11-01", "00:04", "q", "Wrong", "n", "r", "2026-01-01")],
                                  "lead string, category string, claim string, date string, timestamp string, quote string, verdict string, note string, reviewer string, reviewed_at string")
    rows = {r.lead: tuple(r) for r in wl.review_sheet(claims, prior).collect()}
    assert rows == {"1": ("1", "Warm", "c", "2025-12-01", "00:05", "q", "Confirmed", "n", "r", "2026-02-01"), "2": ("2", "Warm", "c", "2026-01-01", "00:10", "q", "", "", "", "")}
