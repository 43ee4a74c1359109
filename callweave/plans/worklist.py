"""The worklist: coded leads graded by the frozen rule and published as rows, journeys, calls and review sheets."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.rules import CATEGORIES, categorise, category_order
from ..operators.journeys import crm_status, last_live, number_calls, outcomes
from ..operators.parts import LINES_PER_PART, text_parts
from ..operators.small import beside, case_of, constants, unpivot_struct, with_scalar

# ---- fixed values: labels ----
TYPE_LABEL = {"sales": "Sales call", "brief_followup": "Follow-up", "enrollment_or_payment": "Enrolment or payment",
              "learner_support": "Learner support", "administrative": "Administrative", "unusable": "No conversation", "unclear": "Unclear"}
RESOLUTION_LABEL = {"resolved": "resolved", "partly_addressed": "partly addressed", "unresolved": "not resolved",
                    "not_addressed": "not addressed", "unclear": "unclear"}
HISTORICAL_CONTEXT = {
    "Hot": "No dependable rate: in past calls this was usually said on the call where the customer paid.",
    "Warm": "Past leads in this position bought at about the average rate (a group estimate, not this lead's chance).",
    "Outside target": "Past leads matching the exclusion bought less often than other leads (a group finding, not this lead's chance).",
    "Cold: declined": "Too few comparable past cases for a dependable comparison.",
    "Dormant: reconfirm": "No dependable comparison: the information is stale, not negative.",
    "Check status": "Not applicable: confirm the lead's purchase status first.",
    "Recording unusable: confirm status": "Not applicable: nothing usable was recorded.",
    "Not reached": "No dependable comparison: the lead was never spoken to."}
REVIEWED = ("Hot", "Warm", "Check status")
PRICING = r"(?iU)discount|final price|price approval|approve.{0,30}price|price.{0,20}approv"
# ---- end of fixed values ----


def as_of(calls):
    """The day the export ends."""
    return calls.agg(F.to_date(F.max("created_on")).alias("as_of"))


def with_last_live(codings, calls):
    """Codings with their lead's last live call; leads nobody reached have none."""
    return with_live(codings, last_live(calls))


def with_live(codings, live):
    """The same from a table of last live calls (lead, live_call_id, live_at, attempts_since)."""
    rows = codings.join(live, "lead", "left")
    silent = F.col("stance").isin("none", "recording_unusable")
    return rows.withColumns({"live_date": F.when(~silent, F.to_date("live_at")), "live_call_id": F.when(~silent, F.col("live_call_id")),
                             "attempts_since": F.coalesce("attempts_since", F.lit(0).cast("bigint"))}).drop("live_at")


def graded(codings, calls, company="the company", cutoff=None):
    """Every open lead with category, reason and days since its last live conversation. `cutoff` is a one-row frame
    (as_of) when the calls are only a part of the export."""
    return graded_from(codings, last_live(calls), outcomes(calls), as_of(calls) if cutoff is None else cutoff, company)


def graded_from(codings, live, flags, cutoff, company="the company"):
    """The same from tables of last live calls and of flags per lead (lead, any_yes)."""
    open_leads = flags.filter(~F.col("any_yes")).select("lead")
    rows = with_scalar(with_live(codings, live).join(open_leads, "lead", "left_semi"), cutoff)
    category, reason = categorise(F.col("as_of"), company)
    return rows.withColumns({"category": category, "reason": reason, "days_since": F.date_diff("as_of", "live_date")})


def published_order(rows):
    """Category order, days since the last conversation (none last), lead."""
    return rows.orderBy(category_order(F.col("category")), F.col("days_since").asc_nulls_last(), "lead")


def category_counts(rows):
    """Leads per category, zero categories included."""
    names = constants(rows.sparkSession, [(c,) for c in CATEGORIES], "category string")
    return names.join(rows.groupBy("category").agg(F.count(F.lit(1)).alias("leads")), "category", "left").na.fill(0, ["leads"])


def cite(label, evidence):
    """`Why: call of 1 Sep 2026 14:02, minute 01:02: “quote”` over an evidence struct with created_on."""
    day = F.when(evidence["day"].isNotNull(), tx.human_date(evidence["day"])).otherwise(evidence["date"])
    when = F.coalesce(F.concat(F.lit(" "), F.date_format(evidence["created_on"], "HH:mm")), F.lit(""))
    return F.concat(label, F.lit(": call of "), day, when, F.lit(", minute "), tx.clock(evidence["start_seconds"]), F.lit(": “"), evidence["quote"], F.lit("”"))


def _decisive_place(category):
    return F.when(category == "Check status", "status_check").when(category == "Outside target", "target_check").otherwise("stance")


def _evidence_struct():
    return F.struct("day", "date", "created_on", "start_seconds", "quote", "topic", "detail", "evidence_no")


def undated(evidence):
    """Citations whose date is no day, as (lead, evidence_no, place, date): a publication with any is refused, a table shows the text as it stands."""
    return evidence.filter(F.col("date").try_cast("date").isNull()).select("lead", "evidence_no", "place", "date")


def worklist_rows(rows, evidence, calls, signed=None):
    """Published rows. `rows` are graded codings, `evidence` their citations; open objections beyond one part's lines
    continue on further rows of the lead (part 2, 3, ...)."""
    cited = evidence.withColumn("day", F.col("date").try_cast("date")).join(
        calls.select("call_id", "created_on"), "call_id", "left")
    wanted = rows.select("lead", _decisive_place(F.col("category")).alias("place"))
    decisive = cited.join(wanted, ["lead", "place"], "left_semi").groupBy("lead").agg(F.min_by(_evidence_struct(), "evidence_no").alias("decisive"))
    objections = cited.filter((F.col("place") == "objection") & (F.col("status") == "open")).join(rows.select("lead"), "lead", "left_semi")
    rank = F.row_number().over(Window.partitionBy("lead").orderBy("evidence_no"))
    first_two = objections.withColumn("__r", rank).filter(F.col("__r") <= 2).groupBy("lead").agg(
        F.array_sort(F.collect_list(F.struct(F.col("__r"), _evidence_struct().alias("e")))).alias("first_two"))
    listed = text_parts(objections, ["lead"], ["evidence_no"], F.floor(F.col("evidence_no") / 4096),
                        F.concat(tx.human_label(F.col("topic")), F.lit(": "), "detail"), "open_objections")
    joined = rows.join(decisive, "lead", "left").join(first_two, "lead", "left").join(listed, "lead", "left")
    if signed is None:
        joined = joined.withColumn("confirmed", F.lit(False))
    else:
        joined = joined.join(signed.select("lead", F.lit(True).alias("confirmed")), "lead", "left")
    c = F.col
    proof = F.concat(
        F.array_compact(F.array(F.when(c("decisive").isNotNull(), cite(F.lit("Why"), c("decisive"))))),
        F.coalesce(F.transform("first_two", lambda x: cite(F.concat(F.lit("Objection ("), x["e"]["topic"], F.lit(")")), x["e"])), F.array().cast("array<string>")))
    proof_text = F.array_join(F.array_distinct(proof), "\n")
    met = case_of(c("condition_can_be_met"), {"yes": "a decision the company controls", "no": "the company does not offer this",
                                             "unclear": "depends on the lead"}, "unclear")
    intent = F.concat(c("buying_intent"), F.coalesce(F.concat(F.lit(" Condition: "), c("condition"), F.lit(" ("), met, F.lit(").")), F.lit("")))
    action = F.concat(F.when(c("category") == "Dormant: reconfirm", "Message the lead to reconfirm interest before any call. If the lead replies: ")
                      .otherwise(""), c("next_action"))
    last = F.when(c("live_date").isNull(), "No usable conversation").otherwise(F.concat(
        tx.human_date(c("live_date")), F.lit(" ("), c("days_since").cast("string"), F.lit(" days before cutoff)")))
    return joined.select("lead", F.coalesce("part", F.lit(1).cast("bigint")).alias("part"), c("category").alias("priority"), "reason",
                         action.alias("next_action"),
                         F.concat(F.lit("Open: "), "opener", F.lit("\nAsk: "), "question", F.lit("\nClose: "), "ask").alias("what_to_say"),
                         F.when(proof_text == "", "No usable recording").otherwise(proof_text).alias("evidence"),
                         case_of(c("category"), HISTORICAL_CONTEXT).alias("historical_context"), last.alias("last_conversation"),
                         intent.alias("buying_intent"), "experience", "role", "ctc", "location",
                         F.concat(F.lit("S: "), "strength", F.lit("\nW: "), "weakness", F.lit("\nO: "), "opportunity", F.lit("\nT: "), "threat").alias("swot"),
                         F.coalesce("open_objections", F.lit("None open")).alias("open_objections"),
                         F.when(F.coalesce("confirmed", F.lit(False)), "Checked against the recording").otherwise("Recording validation pending")
                         .alias("validation"))


def call_length(seconds):
    minutes = F.greatest(F.lit(1), F.rint(seconds / 60).cast("int"))
    return F.when(seconds >= 30, F.concat(minutes.cast("string"), F.lit(" min"))).otherwise("under 1 min")


def call_rows(calls, summaries):
    """Published call rows; `summaries` has call_id and cleaned summary."""
    return calls.join(summaries, "call_id", "left").select(
        "lead", "call_id", "created_on", tx.human_date(F.col("created_on")).alias("date"),
        case_of(F.col("conversation_type"), TYPE_LABEL).alias("type"), call_length(F.col("duration_seconds")).alias("length"), "summary")


def journey_rows(calls, summaries, lines=LINES_PER_PART):
    """Per lead the journey as ordered text (in parts), its status, number of calls, first and last call."""
    rows = number_calls(call_rows(calls, summaries), "number", "calls")
    step = F.concat("date", F.lit(" · "), "type", F.lit(" · "), "length", F.lit(": "), F.coalesce("summary", F.lit("")))
    text = text_parts(rows, ["lead"], None, None, step, "journey", lines=lines, position="number")
    ends = calls.groupBy("lead").agg(F.min("created_on").alias("lo"), F.max("created_on").alias("hi"))
    heads = outcomes(calls).join(ends, "lead").select(
        "lead", crm_status(F.col("all_yes"), F.col("any_yes")).alias("status"), "calls", tx.human_date(F.col("lo")).alias("first_call"),
        tx.human_date(F.col("hi")).alias("last_call"))
    return text.join(heads, "lead")


CLIENT_TEXTS = {"next_action": "next_action", "buying_intent": "buying_intent", "stance.detail": "detail", "stance.condition": "condition",
                "what_to_say.opener": "opener", "what_to_say.question": "question", "what_to_say.ask": "ask", "swot.strength": "strength",
                "swot.weakness": "weakness", "swot.opportunity": "opportunity", "swot.threat": "threat"}


def client_texts(codings):
    """Every text of a coding a client would read, long form (lead, place, text)."""
    return unpivot_struct(codings, ["lead"], [(place, F.col(column)) for place, column in CLIENT_TEXTS.items()], "place", "text")


def export_tables(codings, calls, evidence, summaries, prior, audit):
    """Everything one publication writes: tables and the one-row meta. The release stays a review draft until every
    worklist claim and every audit row is signed."""
    rows = graded(codings, calls)
    sheet = review_sheet(review_claims(rows, evidence), prior)
    status = review_status(sheet)
    tables = {"worklist": worklist_rows(rows, evidence, calls, confirmed_leads(sheet)), "journeys": journey_rows(calls, summaries),
              "calls": call_rows(calls, summaries), "review": sheet, "categories": category_counts(rows)}
    figures = beside(beside(beside(rows.agg(F.count(F.lit(1)).alias("leads"), F.max("as_of").cast("string").alias("as_of")),
                                   calls.agg(F.countDistinct("lead").alias("journeys"), F.count(F.lit(1)).alias("calls"))), status),
                     audit.select(F.col("complete").alias("audit_complete"), "audit_reviewed"))
    tables["meta"] = figures.withColumn("review_draft", ~(F.col("complete") & F.col("audit_complete"))).withColumnRenamed("complete", "claims_complete")
    return tables


def act_now(rows, warm_days=30):
    """Leads to act on first."""
    return rows.filter(F.col("category").isin("Hot", "Check status", "Recording unusable: confirm status")
                       | ((F.col("category") == "Warm") & (F.col("days_since") <= warm_days)))


def narrative_counts(rows):
    """Figures of the report text."""
    reached = ~F.col("category").isin("Not reached", "Recording unusable: confirm status")
    not_asked = (F.col("experience") == "Not asked") | F.contains(F.lower("experience"), F.lit("not stated"))
    waiting = (F.col("condition_can_be_met") == "yes") & F.col("condition").isNotNull()
    pricing = F.concat("next_action", F.lit(" "), "reason").rlike(PRICING)
    return rows.agg(F.count_if(reached).alias("reached"), F.count_if(reached & not_asked).alias("not_asked"),
                    F.count_if(~reached & (F.col("category") == "Not reached")).alias("never"), F.count_if(waiting).alias("waiting"),
                    F.count_if(pricing).alias("pricing"))


def review_claims(rows, evidence):
    """One line per claim to play and sign: the decisive statement, and open objections of reviewed categories."""
    base = evidence.join(rows.select("lead", "category", "status_reason", "target_reason", F.col("detail").alias("stance_detail")), "lead")
    decisive = base.filter(F.col("place") == _decisive_place(F.col("category")))
    statement = (F.when(F.col("place") == "status_check", F.concat(F.lit("status: "), F.coalesce("status_reason", F.lit("None"))))
                 .when(F.col("place") == "target_check", F.concat(F.lit("exclusion: "), F.coalesce("target_reason", F.lit("None"))))
                 .otherwise(F.concat(F.lit("stance: "), "stance_detail")))
    objections = base.filter((F.col("place") == "objection") & (F.col("status") == "open") & F.col("category").isin(*REVIEWED))
    shown = lambda df, claim: df.select("lead", "category", claim.alias("claim"), "date", tx.clock(F.col("start_seconds")).alias("timestamp"), "quote")
    return shown(decisive, statement).unionByName(shown(objections, F.concat(F.lit("objection "), "topic", F.lit(": "), "detail")))


def review_sheet(claims, prior):
    """Claims with earlier rows kept whole: of several prior rows of a (lead, claim, quote) the latest reviewed counts, of equal ones that of the greatest
    content; what a prior row has (category, date and time as well) stands, the rest is the claim's."""
    keys, fields = ["lead", "claim", "quote"], ["verdict", "note", "reviewer", "reviewed_at"]
    held = [c for c in prior.columns if c not in keys]
    latest = prior.groupBy(*keys).agg(F.max(F.struct(F.coalesce("reviewed_at", F.lit("")).alias("__at"), *held)).alias("p"))
    kept = latest.select(*keys, F.lit(True).alias("__had"), *[F.col(f"p.{f}").alias("__" + f) for f in held])
    rows = claims.join(kept, keys, "left")
    whole = [F.when(F.col("__had"), F.col("__" + c)).otherwise(F.col(c)).alias(c) if c in held else F.col(c) for c in claims.columns]
    return rows.select(*whole, *[F.coalesce("__" + f if f in held else F.lit(None).cast("string"), F.lit("")).alias(f) for f in fields])


def is_signed():
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return filled("reviewer") & filled("reviewed_at") & filled("verdict")


def review_status(sheet):
    """Claims, signed claims and whether the sheet is complete."""
    return sheet.agg(F.count(F.lit(1)).alias("claims"), F.count_if(is_signed()).alias("signed")).withColumn(
        "complete", (F.col("claims") > 0) & (F.col("signed") == F.col("claims")))


def confirmed_leads(sheet):
    """Leads whose every claim is signed Confirmed."""
    return sheet.groupBy("lead").agg(F.every(is_signed() & (F.lower(F.trim("verdict")) == "confirmed")).alias("ok")).filter("ok").select("lead")
