"""The closed schemas of extractions, codings and profiles, and the checks of whole JSON files against them."""

from functools import reduce

from pyspark.sql import functions as F

from ..sources.bindings import FACT_FIELDS, MOTIVATIONS, OBJECTION_CATEGORIES, ROLE_GROUPS, SIGNAL_KINDS, STANCES
from ..session import settle
from . import guards
from .closed_schema import Flag, Items, Nullable, Number, Record, Text, Whole, violations

# ---- fixed values: allowed values and limits ----
CALL_TYPES = ("sales", "enrollment_or_payment", "learner_support", "administrative", "brief_followup", "unusable", "unclear")
RESOLUTIONS = ("resolved", "partly_addressed", "unresolved", "unclear")
CODING_TOPICS = ("price", "payment method", "format", "timing", "course fit", "placement", "prerequisites", "family or approval", "trust", "other")
TARGET_ROLE_GROUPS = ("data_engineering", "data_science_ml", "cloud_devops", "data_analytics_bi", "stay_in_current_role", "other", "unknown")
CODING_SCHEMA = "lead-coding-v1"
QUOTE = Record({"segment_id": Whole(0), "quote": Text(10000, 1, filled=True)})
EXTRACTION = Record({
    "conversation_type": Text(choice=CALL_TYPES), "purpose_evidence": Nullable(QUOTE), "summary": Text(900),
    "facts": Items(Record({"field": Text(choice=FACT_FIELDS), "value": Text(400, 1), "evidence": QUOTE}), 20),
    "signals": Items(Record({"kind": Text(choice=SIGNAL_KINDS), "description": Text(500), "evidence": QUOTE}), 15),
    "objections": Items(Record({
        "category": Text(choice=OBJECTION_CATEGORIES), "concern": Text(500, 1), "evidence": QUOTE, "response": Nullable(Text(700)), "response_evidence": Nullable(QUOTE),
        "resolution": Text(choice=RESOLUTIONS), "resolution_evidence": Nullable(QUOTE)}, ("response", "response_evidence", "resolution", "resolution_evidence")), 12),
    "pitches": Items(Record({"topic": Text(400), "evidence": QUOTE, "prospect_response": Nullable(Text(400)), "response_evidence": Nullable(QUOTE)},
                            ("prospect_response", "response_evidence")), 12),
    "next_action": Text(700), "uncertainties": Items(Text(), 10)},
    ("conversation_type", "purpose_evidence", "facts", "signals", "objections", "pitches", "uncertainties"))
CITED = Nullable(Record({"call_id": Text(), "date": Text(), "segment_id": Whole(), "start_seconds": Number(), "quote": Text()}))
SHOWN = Record({"display": Text(), "evidence": CITED})
CODING = Record({
    "schema": Text(choice=(CODING_SCHEMA,)), "lead": Text(), "coder": Text(), "calls_read": Items(Text()),
    "status_check": Record({"needed": Flag(), "reason": Nullable(Text()), "evidence": CITED}),
    "profile": Record({"experience": SHOWN, "role": SHOWN, "ctc": SHOWN, "location": SHOWN}),
    "learner": Record({"value": Text(choice=("self", "someone_else", "unclear")), "evidence": CITED}),
    "target_check": Record({"value": Text(choice=("in_target", "outside_target", "not_asked")), "reason": Nullable(Text()), "evidence": CITED}),
    "stance": Record({"value": Text(choice=STANCES), "detail": Text(), "condition": Nullable(Text()), "condition_can_be_met": Nullable(Text(choice=("yes", "no", "unclear"))),
                      "condition_reason": Nullable(Text()), "evidence": CITED}),
    "refused_after_commitment": Flag(), "last_live_conversation": Nullable(Record({"date": Text(), "call_id": Text()})), "attempts_since_last_live": Whole(),
    "buying_intent": Text(), "their_next_step": Nullable(Text()),
    "objections": Items(Record({"topic": Text(choice=CODING_TOPICS), "detail": Text(), "status": Text(choice=("open", "resolved")), "evidence": CITED})),
    "swot": Record({"strength": Text(), "weakness": Text(), "opportunity": Text(), "threat": Text()}), "next_action": Text(),
    "what_to_say": Record({"opener": Text(), "question": Text(), "ask": Text()})})
REFS = Items(Record({"call_id": Text(), "segment_id": Whole()}), 2)
# Each trait, its values, and the name its evidence goes by.
TRAITS = (("experience_years", Nullable(Number()), "experience"), ("fresher", Text(choice=("yes", "no", "unknown")), "fresher"),
          ("background", Text(choice=("it", "non_it", "unknown")), "background"),
          ("career_gap", Text(choice=("over_1_year", "up_to_1_year", "not_mentioned")), "career_gap"),
          ("employment", Text(choice=("employed", "not_working", "student", "unknown")), "employment"),
          ("current_role_group", Text(choice=ROLE_GROUPS), "current_role"), ("company", Text(), "company"),
          ("location_group", Text(choice=("india", "abroad", "unknown")), "location"), ("salary_lpa", Nullable(Number()), "salary"),
          ("target_role_group", Text(choice=TARGET_ROLE_GROUPS), "target_role"), ("motivation", Text(choice=MOTIVATIONS), "motivation"),
          ("buyer_for", Text(choice=("self", "team_or_juniors", "unknown")), "buyer_for"))
UNKNOWN_TRAITS = ("unknown", "not_mentioned", "")
# ---- end of fixed values ----
PROFILE = Record({name: node for trait, node, evidence in TRAITS for name, node in ((trait, node), (f"{evidence}_evidence", REFS))}
                 | {"current_role": Text(), "location": Text()})

_CITE = "struct<call_id: string, date: string, segment_id: bigint, start_seconds: double, quote: string>"
_SHOWN = f"struct<display: string, evidence: {_CITE}>"
CODING_TYPE = f"""struct<lead: string, coder: string, calls_read: array<string>, status_check: struct<needed: boolean, reason: string, evidence: {_CITE}>,
 profile: struct<experience: {_SHOWN}, role: {_SHOWN}, ctc: {_SHOWN}, location: {_SHOWN}>, learner: struct<value: string, evidence: {_CITE}>,
 target_check: struct<value: string, reason: string, evidence: {_CITE}>,
 stance: struct<value: string, detail: string, condition: string, condition_can_be_met: string, condition_reason: string, evidence: {_CITE}>,
 refused_after_commitment: boolean, last_live_conversation: struct<date: string, call_id: string>, attempts_since_last_live: bigint, buying_intent: string, their_next_step: string,
 objections: array<struct<topic: string, detail: string, status: string, evidence: {_CITE}>>,
 swot: struct<strength: string, weakness: string, opportunity: string, threat: string>, next_action: string, what_to_say: struct<opener: string, question: string, ask: string>>"""


def extraction_violations(files, body="body", keep=("call_id",)):
    return violations(files, body, EXTRACTION, keep)


def profile_violations(files, body="body", keep=("lead",)):
    return violations(files, body, PROFILE, keep)


def coding_violations(files, body="body", keep=("lead",)):
    return violations(files, body, CODING, keep)


def trait_citations(profiles, lines):
    """Problems of profiles (lead, and per trait its value and `<name>_evidence`, a list of call_id and segment_id): a reference to a line that is not
    the lead's own, a known value without a reference. `lines` has lead, call_id and segment_id."""
    cells = F.array(*[F.struct(F.lit(name).alias("trait"), F.col(trait).cast("string").alias("value"), F.col(f"{name}_evidence").alias("refs")) for trait, _, name in TRAITS])
    traits = profiles.select("lead", F.inline(cells))
    known = F.col("value").isNotNull() & ~F.col("value").isin(*UNKNOWN_TRAITS)
    bare = traits.where(known & (F.coalesce(F.size("refs"), F.lit(0)) < 1)).select("lead", F.concat("trait", F.lit(": a known value needs evidence")).alias("problem"))
    refs = traits.select("lead", "trait", F.inline("refs"))
    lost = refs.join(lines.select("lead", "call_id", "segment_id").distinct(), ["lead", "call_id", "segment_id"], "left_anti")
    said = F.concat("trait", F.lit(": reference "), "call_id", F.lit("#"), F.col("segment_id").cast("string"), F.lit(" is not one of the shown lines"))
    return bare.unionByName(lost.select("lead", said.alias("problem")))


def _evidence_rows(coding):
    """(lead, place, evidence fields) of every citation of a coding."""
    single = [("status_check", "status_check.evidence"), ("learner", "learner.evidence"), ("target_check", "target_check.evidence"), ("stance", "stance.evidence"),
              *[(f"profile.{k}", f"profile.{k}.evidence") for k in ("experience", "role", "ctc", "location")]]
    cells = F.array(*[F.struct(F.lit(place).alias("place"), F.col(f"c.{path}").alias("e")) for place, path in single])
    listed = F.transform("c.objections", lambda o, i: F.struct(F.concat(F.lit("objections["), i.cast("string"), F.lit("]")).alias("place"), o["evidence"].alias("e")))
    rows = coding.select("lead", F.inline(F.concat(cells, listed))).where("e is not null")
    return rows.select("lead", "place", "e.*").withColumn("evidence_no", F.col("place"))


def _text_rows(coding):
    """(lead, place, text) of everything a client would read."""
    places = ["buying_intent", "their_next_step", "next_action", *[f"swot.{k}" for k in ("strength", "weakness", "opportunity", "threat")],
              *[f"what_to_say.{k}" for k in ("opener", "question", "ask")], "stance.detail", "stance.condition"]
    cells = F.array(*[F.struct(F.lit(p).alias("place"), F.col(f"c.{p}").alias("text")) for p in places])
    listed = F.transform("c.objections", lambda o, i: F.struct(F.concat(F.lit("objections["), i.cast("string"), F.lit("].detail")).alias("place"), o["detail"].alias("text")))
    return coding.select("lead", F.inline(F.concat(cells, listed))).where("text <> ''")


def check_coding(files, calls, lines, names):
    """Every problem of coding files (lead, body) as rows (lead, place, problem); a lead without rows may be used. A file that breaks the schema is
    reported for that alone. `calls` has call_id, lead, created_on; `lines` the current segments; `names` lead and word."""
    broken = settle(coding_violations(files))
    shape = broken.select("lead", F.col("path").alias("place"), F.concat(F.lit("schema: "), "problem").alias("problem"))
    sound = files.join(broken.select("lead").distinct(), "lead", "left_anti")
    coding = settle(sound.select("lead", F.from_json("body", CODING_TYPE).alias("c")))
    # Whose file it is, and which calls were read.
    owner = coding.where(F.col("c.lead") != F.col("lead")).select("lead", F.lit("lead").alias("place"), F.lit("lead differs from the file's").alias("problem"))
    read = coding.select("lead", F.explode(F.array_distinct("c.calls_read")).alias("call_id"))
    unread = guards.unread_calls(calls.join(coding.select("lead"), "lead", "left_semi"), read).select(
        "lead", F.lit("calls_read").alias("place"), F.lit("calls_read must list all calls of the lead").alias("problem"))
    cited = guards.evidence_problems(_evidence_rows(coding), calls, lines).select("lead", "place", "problem")
    texts = _text_rows(coding)
    worded = guards.wording_problems(texts).select("lead", "place", "problem")
    named = guards.name_problems(texts, names)
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    live = calls.select(F.col("lead").alias("of"), F.col("call_id").alias("live_call_id"), F.to_date("created_on").cast("string").alias("on"))
    flat = coding.select("lead", F.col("c.stance.value").alias("stance"), filled("c.stance.condition").alias("condition"), filled("c.stance.condition_can_be_met").alias("condition_can_be_met"),
                         filled("c.stance.condition_reason").alias("condition_reason"), F.col("c.last_live_conversation.call_id").alias("live_call_id"),
                         F.col("c.last_live_conversation.date").alias("live_date"), F.col("c.target_check.value").alias("target_value"), filled("c.target_check.reason").alias("target_reason"),
                         F.col("c.target_check.evidence").isNotNull().alias("has_target_evidence"), F.col("c.status_check.needed").alias("status_needed"),
                         filled("c.status_check.reason").alias("status_reason"), F.col("c.status_check.evidence").isNotNull().alias("has_status_evidence"))
    flat = flat.join(live, "live_call_id", "left").withColumn("call_matches", (F.col("of") == F.col("lead")) & (F.col("on") == F.col("live_date")))
    stance = guards.stance_problems(flat).select("lead", F.lit("").alias("place"), "problem")
    return reduce(lambda a, b: a.unionByName(b), [shape, owner, unread, cited, worded, named, stance])
