"""Closed schemas and the composed check of coding files."""

import copy
import datetime as dt
import json
import random
import time

import pytest

from callweave.operators import schemas
from callweave.operators.align import edit_counts, fast_edit_counts
from callweave.operators.closed_schema import Flag, Items, Nullable, Number, Record, Text, Whole, violations

SMALL = Record({"name": Text(5, 1, filled=True), "kind": Text(choice=("a", "b")), "size": Whole(0), "rate": Nullable(Number()), "on": Flag(),
                "parts": Items(Record({"at": Whole()}), 2)}, ("rate", "parts"))
GOOD = {"name": "ab", "kind": "a", "size": 3, "on": True}


@pytest.mark.parametrize("change, want", [
    ({}, []), ({"rate": None}, []), ({"rate": 2}, []), ({"rate": 2.5, "parts": []}, []), ({"rate": "2"}, [("rate", "not a number")]),
    ({"name": ""}, [("name", "text too short")]), ({"name": "  "}, [("name", "blank text")]), ({"name": "abcdef"}, [("name", "text too long")]), ({"name": None}, [("name", "not a text")]),
    ({"name": 7}, [("name", "not a text")]), ({"kind": "c"}, [("kind", "value not allowed")]), ({"size": -1}, [("size", "number too small")]), ({"size": 1.5}, [("size", "not a whole number")]),
    ({"on": "yes"}, [("on", "not true or false")]), ({"more": 1, "any": None}, [("any", "unknown key"), ("more", "unknown key")]), ({"parts": {"at": 1}}, [("parts", "not a list")]),
    ({"parts": [{"at": 1}, {"at": "x", "b": 2}]}, [("parts[1].at", "not a whole number"), ("parts[1].b", "unknown key")]),
    ({"parts": [{"at": 1}, {"at": 1}, 5]}, [("parts", "too many items"), ("parts[2]", "not an object")])])
def test_every_place_that_breaks_a_schema_has_a_path(spark, rows, change, want):
    df = spark.createDataFrame([(1, json.dumps(GOOD | change))], "id int, body string")
    assert rows(violations(df, "body", SMALL, ["id"])) == sorted(((1, *w) for w in want), key=repr)


def test_missing_fields_and_broken_text(spark, rows):
    bodies = [json.dumps({"name": "x", "kind": "b"}), "{", None, "[1]", '"text"', "null"]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    assert rows(violations(df, "body", SMALL, ["id"])) == sorted([
        (0, "on", "missing"), (0, "size", "missing"), (1, "", "not JSON"), (2, "", "not JSON"), (3, "", "not an object"), (4, "", "not an object"), (5, "", "not an object")], key=repr)


def cite(call="K1", day="2026-04-02", segment=3, start=61.0, quote="three blue kites"):
    return {"call_id": call, "date": day, "segment_id": segment, "start_seconds": start, "quote": quote}


CODED = {
    "schema": "lead-coding-v1", "lead": "71", "coder": "p", "calls_read": ["K1", "K2"], "status_check": {"needed": False, "reason": None, "evidence": None},
    "profile": {k: {"display": "d", "evidence": None} for k in ("experience", "role", "ctc", "location")}, "learner": {"value": "self", "evidence": None},
    "target_check": {"value": "in_target", "reason": None, "evidence": None},
    "stance": {"value": "open", "detail": "weighs it", "condition": None, "condition_can_be_met": None, "condition_reason": None, "evidence": cite()},
    "refused_after_commitment": False, "last_live_conversation": {"date": "2026-04-05", "call_id": "K2"}, "attempts_since_last_live": 0, "buying_intent": "some",
    "their_next_step": None, "objections": [{"topic": "price", "detail": "the fee", "status": "open", "evidence": cite()}],
    "swot": {k: "plain" for k in ("strength", "weakness", "opportunity", "threat")}, "next_action": "Send the plan.", "what_to_say": {"opener": "Hello", "question": "Which one?", "ask": "Join us?"}}
BREAKS = [
    ("lead", "72", ("lead", "lead differs from the file's")), ("calls_read", ["K1"], ("calls_read", "calls_read must list all calls of the lead")),
    ("calls_read", ["K1", "K2", "K9"], ("calls_read", "calls_read must list all calls of the lead")),
    ("objections.0.evidence", cite("K9"), ("objections[0]", "call is not this lead's")), ("learner.evidence", cite(day="2026-04-03"), ("learner", "date differs from the call date")),
    ("stance.evidence", cite(segment=8), ("stance", "segment not in call")), ("profile.role.evidence", cite(start=64.5), ("profile.role", "start differs from the segment start")),
    ("stance.evidence", cite(quote="four kites"), ("stance", "quote is not verbatim")), ("stance.evidence", cite(quote="?!"), ("stance", "quote is not verbatim")),
    ("stance.evidence", cite(segment=4, start=80.0, quote=" ".join(f"n{i}" for i in range(16))), ("stance", "quote longer than 15 words")),
    ("buying_intent", "the model says so", ("buying_intent", "internal word model")), ("swot.threat", "he waits", ("swot.threat", "gendered pronoun he")),
    ("objections.0.detail", "see www.x", ("objections[0].detail", "contact detail www.")), ("their_next_step", "ask Ravina", ("their_next_step", "personal name ravina")),
    ("next_action", "Call tomorrow.", ("next_action", "relative timing tomorrow")),
    ("what_to_say.ask", "Take the discount", ("what_to_say.ask", "a discount, offer or trial must be conditional on current approval")),
    ("swot.strength", "w " * 26, ("swot.strength", "over 25 words")), ("next_action", "w " * 51, ("next_action", "over 50 words")),
    ("stance.value", "conditional_commitment", ("", "a conditional commitment needs condition, condition_can_be_met and condition_reason")),
    ("stance.value", "none", ("", "a last live conversation is given for a lead nobody reached")), ("last_live_conversation", None, ("", "a stance other than none needs the last live conversation")),
    ("last_live_conversation", {"date": "2026-04-06", "call_id": "K2"}, ("", "last_live_conversation does not match one of the lead's calls")),
    ("last_live_conversation", {"date": "2026-04-05", "call_id": "Z1"}, ("", "last_live_conversation does not match one of the lead's calls")),
    ("target_check.value", "outside_target", ("", "outside_target needs a reason and evidence")), ("status_check", {"needed": True, "reason": "", "evidence": cite()}, ("", "a status check needs a reason and evidence")),
    ("stance.value", "eager", ("stance.value", "schema: value not allowed")), ("swot.luck", "x", ("swot.luck", "schema: unknown key"))]


def test_every_coding_rule(spark):
    files = [("0", json.dumps(CODED | {"lead": "0"}))]
    for n, (path, value, _) in enumerate(BREAKS, 1):
        body = copy.deepcopy(CODED) | {"lead": str(n)}
        at = body
        *way, last = path.split(".")
        for step in way:
            at = at[int(step)] if step.isdigit() else at[step]
        at[int(last) if last.isdigit() else last] = value
        files.append((str(n), json.dumps(body).replace('"K', f'"{n}K')))
    files[0] = ("0", files[0][1].replace('"K', '"0K'))
    calls, lines = [("Z1", "z", dt.datetime(2026, 4, 5))], []
    for n in range(len(BREAKS) + 1):
        calls += [(f"{n}K1", str(n), dt.datetime(2026, 4, 2, 9)), (f"{n}K2", str(n), dt.datetime(2026, 4, 5, 9))]
        lines += [(f"{n}K1", 3, 60.0, "I saw Three blue kites."), (f"{n}K1", 4, 80.0, " ".join(f"n{i}" for i in range(20)))]
    out = schemas.check_coding(spark.createDataFrame(files, "lead string, body string"), spark.createDataFrame(calls, "call_id string, lead string, created_on timestamp_ntz"),
                               spark.createDataFrame(lines, "call_id string, segment_id bigint, start double, text string"),
                               spark.createDataFrame([(str(n), "ravina") for n in range(len(files))], "lead string, word string")).collect()
    found = {}
    for r in out:
        found.setdefault(int(r.lead), set()).add((r.place, r.problem))
    for n, (path, value, want) in enumerate(BREAKS, 1):
        assert found.pop(n, None) == {want}, (path, value)
    assert not found


def test_profile_traits_and_their_citations(spark, rows):
    body = {"current_role": "x", "location": "y"}
    for trait, _, name in schemas.TRAITS:
        body |= {trait: None if trait in ("experience_years", "salary_lpa") else "unknown" if trait != "company" else "", f"{name}_evidence": []}
    body["career_gap"] = "not_mentioned"
    known = body | {"experience_years": 4.5, "motivation": "other", "motivation_evidence": [{"call_id": "K1", "segment_id": 2}], "buyer_for": "self", "buyer_for_evidence": [{"call_id": "K1", "segment_id": 9}]}
    bad = body | {"fresher": "perhaps", "company_evidence": [{"call_id": "K1", "segment_id": 2}] * 3}
    df = spark.createDataFrame([("1", json.dumps(known)), ("2", json.dumps(bad))], "lead string, body string")
    assert rows(schemas.profile_violations(df)) == [("2", "company_evidence", "too many items"), ("2", "fresher", "value not allowed")]
    kind = "lead string, " + ", ".join(f"{t} string, {n}_evidence array<struct<call_id: string, segment_id: bigint>>" for t, _, n in schemas.TRAITS)
    flat = [("1", *[v if c.endswith("evidence") else None if v is None else str(v) for t, _, n in schemas.TRAITS for c, v in ((t, known[t]), (f"{n}_evidence", [tuple(r.values()) for r in known[f"{n}_evidence"]]))])]
    lines = spark.createDataFrame([("1", "K1", 2), ("2", "K1", 9)], "lead string, call_id string, segment_id bigint")
    assert rows(schemas.trait_citations(spark.createDataFrame(flat, kind), lines)) == [
        ("1", "buyer_for: reference K1#9 is not one of the shown lines"), ("1", "experience: a known value needs evidence")]


def test_bit_columns_equal_the_plain_table():
    rng = random.Random(2)
    for _ in range(1500):
        k = rng.choice([2, 3, 12])
        a, b = [[rng.randrange(k) for _ in range(rng.randrange(30))] for _ in range(2)]
        if rng.random() < 0.5:
            b = [x for x in a if rng.random() < 0.9]
        assert fast_edit_counts(a, b) == edit_counts(a, b)
    a = [rng.randrange(500) for _ in range(10_000)]
    b = [x if rng.random() > 0.1 else -x for x in a if rng.random() < 0.95]
    start = time.time()
    hits, swaps, drops, adds = fast_edit_counts(a, b)
    assert time.time() - start < 1.5 and hits + swaps + drops == len(a) and hits + swaps + adds == len(b)
