"""Grading rule, guards and wording on own cases."""

import datetime as dt
import itertools
import re

import pytest
from pyspark.sql import functions as F

from callweave.functions import rules, text as tx
from callweave.operators import guards, redact
from callweave.plans import worklist as wl

TODAY = dt.date(2025, 5, 20)
FIELDS = ("lead string, stance string, detail string, condition string, condition_can_be_met string, condition_reason string, refused_after_commitment boolean, "
          "status_needed boolean, status_reason string, target_value string, target_reason string, live_date date, attempts_since bigint")


def coded(lead, stance, met=None, refused=False, status=None, outside=None, days=10, attempts=3):
    return (lead, stance, "Wants a place in June", "a weekend slot" if met else None, met, "asked twice" if met else None, refused, status is not None, status,
            "outside_target" if outside else "not_asked", outside, None if days is None else TODAY - dt.timedelta(days=days), attempts)


def graded(spark, rows):
    category, reason = rules.categorise(F.lit(str(TODAY)).cast("date"))
    return {r.lead: (r.category, r.reason) for r in spark.createDataFrame(rows, FIELDS).select("lead", category.alias("category"), reason.alias("reason")).collect()}


def test_earlier_rules_win_over_later_ones(spark):
    """Every stance, plain and with each overriding mark."""
    stances = ["commitment", "open", "open_deferral", "declined", "product_not_sold"]
    rows = []
    for stance in stances:
        rows += [coded(f"{stance}/plain", stance), coded(f"{stance}/status", stance, status="Paid already", outside="Wrong field"),
                 coded(f"{stance}/outside", stance, outside="Wrong field")]
    got = graded(spark, rows)
    for stance in stances:
        assert got[f"{stance}/status"] == ("Check status", "Paid already")
        assert got[f"{stance}/outside"][0] == "Outside target"
    plain = {s: got[f"{s}/plain"][0] for s in stances}
    assert plain == {"commitment": "Hot", "open": "Warm", "open_deferral": "Warm", "declined": "Cold: declined", "product_not_sold": "Cold: declined"}


def test_conditions_and_refusals(spark):
    rows = [coded(f"{met}/{refused}", "conditional_commitment", met=met, refused=refused) for met, refused in itertools.product(["yes", "no", "unclear"], [False, True])]
    got = {k: v[0] for k, v in graded(spark, rows + [coded("plain/refused", "commitment", refused=True), coded("bare", "conditional_commitment")]).items()}
    assert got["yes/False"] == "Hot" and got["no/False"] == "Cold: declined" and got["unclear/False"] == "Warm" and got["bare"] == "Warm"
    assert got["plain/refused"] == "Warm"
    assert "weekend slot" in graded(spark, [coded("x", "conditional_commitment", met="yes")])["x"][1]


def test_age_and_reach(spark):
    got = graded(spark, [coded("fresh", "commitment", days=5), coded("old", "commitment", days=60), coded("older", "commitment", days=110), coded("silent", "none", days=None, attempts=4),
                         coded("broken", "recording_unusable", days=None), coded("nodate", "open", days=None)])
    assert {k: v[0] for k, v in got.items()} == {"fresh": "Hot", "old": "Warm", "older": "Dormant: reconfirm", "silent": "Not reached",
                                                  "broken": "Recording unusable: confirm status", "nodate": "Warm"}
    assert "4 recorded calls" in got["silent"][1] and "5 days" in got["fresh"][1]


def problems(spark, place, text):
    return [r.problem for r in guards.wording_problems(spark.createDataFrame([("9", place, text)], "lead string, place string, text string")).collect()]


@pytest.mark.parametrize("place, text, problem", [
    ("swot.threat", "She may look elsewhere.", "gendered pronoun"), ("buying_intent", "According to the model, ready.", "internal word"),
    ("what_to_say.opener", "Write to desk@school.example first.", "contact detail"), ("next_action", "Ring the lead next week.", "relative timing"),
    ("swot.opportunity", "y " * 30, "over 25"), ("next_action", "y " * 60, "over 50")])
def test_wording_guards_report(spark, place, text, problem):
    assert any(problem in p for p in problems(spark, place, text))


@pytest.mark.parametrize("text", ["Share the weekend timetable and ask which slot fits.", "Once the lead picks a slot, the counsellor books the place."])
def test_wording_guards_let_plain_text_pass(spark, text):
    assert problems(spark, "next_action", text) == []


def test_a_lead_may_not_read_its_own_people(spark):
    texts = spark.createDataFrame([(lead, "next_action", "Morwen books the slot.") for lead in ("7", "8")], "lead string, place string, text string")
    people = spark.createDataFrame([("8", "morwen"), ("8", "talek"), ("7", "talek")], "lead string, word string")
    assert [(r.lead, r.problem) for r in guards.name_problems(texts, people).collect()] == [("8", "personal name morwen")]


def test_each_broken_part_of_a_citation_is_named(spark):
    calls = spark.createDataFrame([("7", "X1", dt.datetime(2025, 4, 3, 9)), ("7", "X2", dt.datetime(2025, 4, 8, 9))], "lead string, call_id string, created_on timestamp_ntz")
    lines = spark.createDataFrame([("X1", 5, 31.5, "Sure, June suits me, the weekend one.")], "call_id string, segment_id bigint, start double, text string")
    right = {"lead": "7", "evidence_no": 1, "place": "stance", "call_id": "X1", "date": "2025-04-03", "segment_id": 5, "start_seconds": 31.5, "quote": "June suits me"}
    schema = "lead string, evidence_no bigint, place string, call_id string, date string, segment_id bigint, start_seconds double, quote string"
    broken = [({}, None), ({"quote": "July suits me"}, "quote is not verbatim"), ({"segment_id": 6}, "segment not in call"), ({"call_id": "X7"}, "call is not this lead's"),
              ({"date": "2025-04-04"}, "date differs from the call date"), ({"start_seconds": 40.0}, "start differs from the segment start")]
    rows = [tuple((right | change | {"evidence_no": n}).values()) for n, (change, _) in enumerate(broken)]
    got = {}
    for r in guards.evidence_problems(spark.createDataFrame(rows, schema), calls, lines).collect():
        got.setdefault(r.evidence_no, []).append(r.problem)
    assert got == {n: [problem] for n, (_, problem) in enumerate(broken) if problem}


def one(spark, fn, text):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]


@pytest.mark.parametrize("text, want", [
    ("She is away; he has the keys.", "They are away; they have the keys."), ("The keys are hers, so ask him.", "The keys are theirs, so ask them."),
    ("Give her brother his coat, then ring her again.", "Give their brother their coat, then ring them again."), ("Theme, sheet, there.", "Theme, sheet, there.")])
def test_pronouns_are_neutral(spark, text, want):
    assert one(spark, tx.neutral, text) == want


def test_house_terms(spark):
    assert one(spark, tx.wording, "Agents met two prospects.") == "Counsellors met two leads."
    assert one(spark, tx.wording, "Then the lead the prospect left; reagents stay.") == "Then the lead left; reagents stay."


def test_names_leave_published_text(spark):
    texts = ["Brisca rang Toril about June.", "The mentor, Ulva, was there.", "Quenby told the lead about it."]
    df = spark.createDataFrame([(i, "7", t) for i, t in enumerate(texts)], "text_id int, lead string, text string")
    listed = lambda *w: spark.createDataFrame([(x,) for x in w], "word string")
    own = redact.own_words(spark.createDataFrame([("7", "Toril Vane")], "lead string, lead_name string"))
    got = {r.text_id: r.text for r in redact.redact(df, own, listed("brisca"), listed("toril", "vane", "quenby")).collect()}
    assert got == {0: "the counsellor rang the lead about June.", 1: "The mentor, was there.", 2: "another person told the lead about it."}


@pytest.mark.parametrize("value, safe", [("=1+1", False), ("  -5", False), ("@name", False), ("+9", False), ("plain = text", True), ("5-1", True)])
def test_cells_that_a_sheet_would_run(spark, value, safe):
    assert one(spark, tx.safe_cell, value) == (value if safe else "'" + value)


def test_secret_scan_by_path_and_content(spark):
    rows = [("src/readme.txt", "k AIza" + "b" * 35), ("talk.wav", "x"), ("deep/.env", "A=1"), ("deep/.env.example", "A="), ("link.txt", "see https://rec.test/77"), ("fine.py", "print()")]
    got = {r.path: r.reason for r in guards.secret_scan(spark.createDataFrame(rows, "path string, content string"), "rec.test").collect()}
    assert got == {"src/readme.txt": "api key", "talk.wav": "private file", "deep/.env": "private file", "link.txt": "recording link"}


def test_published_context_has_no_figures():
    assert not [t for t in wl.HISTORICAL_CONTEXT.values() if re.search(r"\d", t)]


def test_dates_clock_and_labels(spark):
    row = spark.sql("select timestamp_ntz'2025-12-24 08:05:00' as t, 3599.9D as s").select(tx.human_date(F.col("t")), tx.clock(F.col("s")), tx.human_label(F.lit("TIME_of_day"))).first()
    assert (row[0], row[2]) == ("24 Dec 2025", "Time of day") and row[1] == "59:59"


def test_normal_forms(spark):
    assert one(spark, tx.normalise, "Um, about 2.75 Mio. in Große Str!") == "about 2.75 mio in grosse str"
    assert one(spark, tx.compact, "Rain coat 6.15") == "raincoat615"
    assert one(spark, tx.norm, "We'll  go: ON Monday!") == "we'll go on monday"
