"""Evidence tables, summaries, labels and cost figures over analysed calls."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.rules import priority_label
from ..operators.journeys import moment, outcomes
from ..operators.parts import text_parts
from ..operators.ranking import positions
from ..operators.small import beside, case_of, unpivot_struct

# ---- fixed values ----
RESOLUTIONS = ("resolved", "partly_addressed", "unresolved", "unclear")
SALES_FACING = ("sales", "enrollment_or_payment")
NO_QUALITY = ("learner_support", "administrative", "unusable")
QUALIFICATION = ("current_role", "experience", "technology_interest", "budget")
DISCOVERY = ("goal", "target_role", "timeline")
CLOSING = ("payment_intent", "followup_agreed", "demo_requested")
KEY_FIELDS = ("goal", "timeline", "budget")
STRENGTHS = ("goal", "urgency", "payment_intent")
PHASE_BUDGET_INR = 35000
FX = 125.0
# ---- end of fixed values ----


def analysed(calls, extractions):
    return calls.join(extractions.filter("analysed").drop("analysed"), "call_id")


def call_table(calls, extractions):
    """Every call; those without an extraction stay as pending."""
    done = extractions.filter("analysed").select("call_id", "summary", "next_action", F.lit(True).alias("done"))
    return calls.join(done, "call_id", "left").withColumn(
        "processing_status", F.when(F.col("done"), "Evidence checked; semantic QA pending").otherwise("Pending or failed extraction")).drop("done")


def objection_summary(items):
    """Instances, distinct calls and resolutions per category; most calls first."""
    rows = items.filter(F.col("collection") == "objections").groupBy(F.col("label").alias("category")).agg(
        F.count(F.lit(1)).alias("instances"), F.countDistinct("call_id").alias("calls"),
        *[F.count_if(F.col("resolution") == r).alias(r) for r in RESOLUTIONS])
    return rows.orderBy(F.col("calls").desc(), "category")


def signal_summary(items):
    rows = items.filter(F.col("collection") == "signals").groupBy(F.col("label").alias("kind")).agg(F.countDistinct("call_id").alias("calls"))
    return rows.orderBy(F.col("calls").desc(), "kind")


def examples(items, calls, k=3):
    """First k examples per label in journey order: each objection counts, signals once per call. Both are cut per task
    before the shuffle (rank limit)."""
    order = ("lead", "created_on", "call_id", "item_pos")
    objections = items.filter(F.col("collection") == "objections").select("call_id", "label", "item_pos", "text", F.lit("objection").alias("kind"))
    signals = items.filter(F.col("collection") == "signals").groupBy("call_id", "label").agg(
        F.min(F.struct("item_pos", "text")).alias("x")).select("call_id", "label", "x.item_pos", "x.text", F.lit("signal").alias("kind"))
    rows = objections.unionByName(signals).join(calls.select("call_id", "lead", "created_on"), "call_id")
    rank = F.row_number().over(Window.partitionBy("kind", "label").orderBy(*order))
    return rows.withColumn("example", rank).filter(F.col("example") <= k)


def top_values(items, calls, field, k=8):
    """Most frequent stated values of a fact field in sales-facing calls, one count per call; ties by value."""
    rows = items.filter((F.col("collection") == "facts") & (F.col("label") == field)).join(
        calls.filter(F.col("conversation_type").isin(*SALES_FACING)).select("call_id"), "call_id", "left_semi")
    return rows.groupBy(F.lower(F.trim("text")).alias("value")).agg(F.countDistinct("call_id").alias("calls")).orderBy(
        F.col("calls").desc(), "value").limit(k)


def call_quality(items, calls):
    """Coverage flags per call; service and unusable calls have none."""
    of = lambda collection, labels: F.some((F.col("collection") == collection) & F.col("label").isin(*labels))
    flags = items.groupBy("call_id").agg(
        of("facts", QUALIFICATION).alias("qualification"), of("facts", DISCOVERY).alias("discovery"), F.some(F.col("collection") == "pitches").alias("pitch"),
        F.some((F.col("collection") == "objections") & F.col("response").isNotNull()).alias("objection_handling"),
        of("signals", CLOSING).alias("closing"), F.some(F.col("collection") == "objections").alias("has_objections"))
    return calls.filter(~F.col("conversation_type").isin(*NO_QUALITY)).join(flags, "call_id", "left")


def quality_coverage(items, calls):
    """Calls with evidence per quality dimension over that dimension's own denominator."""
    dims = ("qualification", "discovery", "pitch", "objection_handling", "closing")
    sales = call_quality(items, calls.filter(F.col("conversation_type").isin(*SALES_FACING)))
    totals = sales.agg(F.count(F.lit(1)).alias("n"), F.count_if("has_objections").alias("o"), *[F.count_if(d).alias(d) for d in dims])
    return totals.select(F.inline(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("calls_with_evidence"),
                                                     F.col("o" if d == "objection_handling" else "n").alias("applicable_calls")) for d in dims])))


def latest_values(items, calls):
    """Latest value per (lead, fact field) and whether the lead gave more than one."""
    rows = items.filter(F.col("collection") == "facts").select("call_id", "label", "text", "item_pos").join(
        calls.select("call_id", "lead", "created_on"), "call_id")
    return rows.groupBy("lead", F.col("label").alias("field")).agg(
        F.max_by("text", F.struct("created_on", "call_id", "item_pos")).alias("value"), (F.countDistinct("text") > 1).alias("conflicting"))


def profile_table(items, calls, fields):
    """Wide: latest value per field, and the conflicting fields' names (at most one per field)."""
    long = latest_values(items, calls)
    pick = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    conflicts = F.array_join(F.array_sort(F.collect_set(F.when(F.col("conflicting"), F.col("field")))), "; ").alias("conflicting_fields")
    return long.groupBy("lead").agg(*pick, conflicts)


def signal_flags(items):
    has = lambda *kinds: F.some((F.col("collection") == "signals") & F.col("label").isin(*kinds))
    return items.groupBy("call_id").agg(
        has("do_not_contact").alias("dnc"), has("payment_intent").alias("payment_intent"), has("urgency").alias("urgency"), has("demo_requested").alias("demo"),
        has("followup_agreed").alias("followup"), has("low_interest", "not_a_fit").alias("cold"),
        has("followup_agreed", "demo_requested", "price_question", "goal").alias("warm"), has("payment_intent", "payment_claim").alias("pay"))


FLAGS = ("dnc", "payment_intent", "urgency", "demo", "followup", "cold", "warm", "pay")


def journey_state(calls, extractions, items):
    """Per lead everything the priority label and the next action need. Aggregates only; the last live call travels as
    one struct, so no window sorts a journey."""
    done = extractions.filter("analysed").select("call_id", "next_action", F.lit(True).alias("done"))
    rows = calls.join(done, "call_id", "left").join(signal_flags(items), "call_id", "left")
    flags = {f: F.coalesce(F.col(f), F.lit(False)) & F.coalesce(F.col("done"), F.lit(False)) for f in FLAGS}
    rows = rows.withColumns(flags)
    is_live = F.coalesce(F.col("done"), F.lit(False)) & (F.col("conversation_type") != "unusable")
    live = F.max(F.when(is_live, F.struct("created_on", "call_id", "conversation_type", "next_action", *FLAGS)))
    per_lead = rows.groupBy("lead").agg(F.count(F.lit(1)).alias("calls"), F.count_if("done").alias("calls_analysed"), F.some("dnc").alias("any_dnc"),
                                        F.some("pay").alias("any_pay"), F.sum("duration_seconds").alias("seconds"), live.alias("live"))
    per_lead = per_lead.join(outcomes(calls).select("lead", "any_yes"), "lead")
    later = calls.select("lead", "created_on", "call_id").join(per_lead.select("lead", F.struct("live.created_on", "live.call_id").alias("at"), F.col("live").isNull().alias("none")), "lead")
    unanswered = later.groupBy("lead").agg(F.count_if(~F.col("none") & (moment() > F.col("at"))).alias("unanswered"))
    state = per_lead.join(unanswered, "lead").withColumns({
        "complete": F.col("calls") == F.col("calls_analysed"), "has_live": F.col("live").isNotNull(), "live_type": F.col("live.conversation_type"),
        "live_payment_intent": F.col("live.payment_intent"), "live_urgency": F.col("live.urgency"), "live_demo": F.col("live.demo"),
        "live_followup": F.col("live.followup"), "live_cold": F.col("live.cold"), "live_warm": F.col("live.warm"), "live_action": F.col("live.next_action")})
    label, reason = priority_label()
    return state.withColumns({"priority": label, "priority_reason": reason}).drop("live")


def open_objections(calls, extractions, items):
    """Objections not resolved in their own call, in journey order, with their lead."""
    rows = items.filter((F.col("collection") == "objections") & (F.col("resolution") != "resolved")).select("call_id", "item_pos", "label", "text", "resolution")
    return rows.join(analysed(calls, extractions).select("call_id", "lead", "created_on"), "call_id")


def objection_texts(calls, extractions, items):
    """Open objections and threats per lead as text, in parts of bounded size."""
    placed = positions(open_objections(calls, extractions, items), ["lead"], ["created_on", "call_id", "item_pos"], F.to_date("created_on"), "n")
    line = F.concat("label", F.lit(": "), "text", F.lit(" ("), "call_id", F.lit(")"))
    texts = text_parts(placed, ["lead"], None, None, line, "open_objections", "; ", position="n")
    threats = text_parts(placed, ["lead"], None, None, F.col("label"), "threats", "; ", position="n")
    return texts.join(threats, ["lead", "part"])


def strengths(calls, extractions, items, chars=1200):
    """Distinct strength statements of a lead in order of first mention, cut at `chars`. A statement takes at least one
    character and its separator two, so the first 400 hold everything the cut can show."""
    rows = items.filter((F.col("collection") == "signals") & F.col("label").isin(*STRENGTHS)).select("call_id", "item_pos", "text")
    rows = rows.join(analysed(calls, extractions).select("call_id", "lead", "created_on"), "call_id")
    first = rows.groupBy("lead", "text").agg(F.min(F.struct("created_on", "call_id", "item_pos")).alias("at"))
    rank = F.row_number().over(Window.partitionBy("lead").orderBy("at"))
    kept = first.withColumn("n", rank).filter(F.col("n") <= chars // 3 + 1)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x["text"])
    return kept.groupBy("lead").agg(F.left(F.array_join(listed, "; "), F.lit(chars)).alias("strengths"))


def lead_report(calls, extractions, items):
    """Workflow row per lead: label, next action, effort rule and what is open or unknown."""
    state = journey_state(calls, extractions, items)
    opened = open_objections(calls, extractions, items).groupBy("lead").agg(F.count(F.lit(1)).alias("open_count"))
    known = latest_values(items.join(extractions.filter("analysed").select("call_id"), "call_id", "left_semi"), calls).groupBy("lead").agg(
        *[F.some(F.col("field") == f).alias("has_" + f) for f in KEY_FIELDS])
    rows = state.join(opened, "lead", "left").join(known, "lead", "left").join(strengths(calls, extractions, items), "lead", "left")
    rows = rows.na.fill(0, ["open_count"]).na.fill(False, ["has_" + f for f in KEY_FIELDS]).na.fill("", ["strengths"])
    c = F.col
    lead_in = F.when(c("unanswered") > 0, F.concat(F.lit("The last "), c("unanswered").cast("string"), F.lit(
        " call(s) reached voicemail or no conversation. From the last live conversation: "))).otherwise("")
    action = (F.when(~c("complete"), "Finish reviewing the available calls.")
              .when(~c("has_live"), "No call reached the lead. Confirm the phone number and try another channel such as WhatsApp or email before further calls.")
              .otherwise(F.concat(lead_in, "live_action")))
    action = (F.when(c("priority") == "Verify enrollment", F.concat(F.lit(
        "Confirm enrollment/payment and current lead status before any further sales outreach. "), action))
        .when(c("priority") == "Do not contact", "Respect the request to stop contact; confirm the CRM suppression setting.").otherwise(action))
    effort = F.when(~c("complete"), "Not assessed: journey extraction incomplete").when(
        (c("seconds") >= 1800) & (c("open_count") >= 2) & ~c("any_pay"), "Review effort").otherwise("No rule triggered")
    unknown = F.array_join(F.array_compact(F.array(*[F.when(~c("has_" + f), f) for f in KEY_FIELDS])), "; ")
    weak = F.when(~c("complete"), "Analysis incomplete").when(unknown == "", "No missing key discovery fields detected").otherwise(unknown)
    chance = (F.when(~c("complete"), "Complete the journey review")
              .when(c("open_count") > 0, "Address the documented concern and agree a specific next step")
              .otherwise("Confirm current need and readiness before proposing a next step"))
    return rows.select("lead", "priority", "priority_reason", "calls", "calls_analysed", "unanswered", "open_count", action.alias("next_action_suggestion"),
                       effort.alias("effort_review"), weak.alias("weaknesses_or_unknowns"), chance.alias("opportunity"), "strengths")


def evidence_table(items, calls, segments):
    """One row per cited evidence with its words' time; response and resolution evidence carry their own claim."""
    kinds = [("evidence", "segment_id", F.col("text")), ("response_evidence", "response_segment_id", F.col("response")),
             ("resolution_evidence", "resolution_segment_id", F.concat("resolution", F.lit(": "), "text"))]
    cells = F.array(*[F.struct(F.lit(kind).alias("evidence_type"), F.col(seg).alias("cited_id"), claim.alias("claim")) for kind, seg, claim in kinds])
    long = items.select("call_id", "collection", "item_pos", "label", F.inline(cells)).filter(F.col("cited_id").isNotNull())
    spoken = segments.select("call_id", F.col("segment_id").alias("cited_id"), "start", "end_at")
    return long.join(spoken, ["call_id", "cited_id"]).join(calls.select("call_id", "lead"), "call_id")


def overview(calls, extractions, items):
    """One row of headline figures."""
    done = analysed(calls, extractions)
    figures = calls.agg(F.count(F.lit(1)).alias("selected_calls"), F.countDistinct("lead").alias("selected_leads"))
    per_lead = calls.join(extractions.filter("analysed").select("call_id", F.lit(1).alias("d")), "call_id", "left").groupBy("lead").agg(
        (F.count("d") == F.count(F.lit(1))).alias("complete"))
    complete = per_lead.agg(F.count_if("complete").alias("complete_extracted_journeys"))
    mentions = items.filter(F.col("collection") == "objections").join(done.select("call_id"), "call_id", "left_semi").select("call_id", "label").distinct()
    return beside(beside(beside(figures, done.agg(F.count(F.lit(1)).alias("analysed_calls"))), complete),
                  mentions.agg(F.count(F.lit(1)).alias("objection_mentions_by_call")))


def cost_summary(ledger, calls, committed, rate_per_hour=None):
    """Spend over all attempts against unique call minutes; retries cost, minutes count once. `committed` is a one-row
    frame (committed_inr). All sums are partial per task; nothing is joined row by row but the call semi-join."""
    remote = F.col("stage") == "remote_usage"
    mine = ledger.join(calls.select("call_id").distinct().withColumn("ours", F.lit(True)), "call_id", "left").na.fill(False, ["ours"])
    inference = F.col("ours") & F.col("stage").isin("transcribe", "extract", "resolve", "verify")
    cost = F.coalesce("external_cost_inr", F.lit(0.0))
    # A remote_usage event of a selected call is counted by both rules, as spend by call and as provider usage.
    spend = mine.agg((F.sum(F.when(F.col("ours"), cost).otherwise(0.0)) + F.sum(F.when(remote, cost).otherwise(0.0))).alias("external_api_spend_inr"),
                     (F.sum(F.when(inference, F.col("wall_seconds"))) / 3600).alias("wall_hours"),
                     F.count_if(inference & (F.col("status") == "failed")).alias("failed_attempts"))
    heard = ledger.filter((F.col("stage") == "transcribe") & (F.col("status") == "success")).select("call_id").distinct()
    minutes = calls.join(heard, "call_id", "left_semi").agg((F.coalesce(F.sum("duration_seconds"), F.lit(0)) / 60).alias("unique_transcribed_audio_minutes"))
    archive = calls.agg((F.sum("duration_seconds") / 60).alias("archive_minutes"))
    rows = beside(beside(beside(spend, minutes), archive), committed)
    m, spent = F.nullif(F.col("unique_transcribed_audio_minutes"), F.lit(0.0)), F.col("external_api_spend_inr")
    total = spent + F.col("wall_hours") * F.lit(rate_per_hour).cast("double")
    left = F.col("archive_minutes") - F.col("unique_transcribed_audio_minutes")
    return rows.withColumns({
        "unreconciled_reserve_inr": F.col("committed_inr") - spent, "external_api_inr_per_audio_minute": spent / m, "processing_cost_inr": total,
        "processing_inr_per_audio_minute": total / m, "phase_remaining_audio_minutes": F.rint(left),
        "phase_allowed_inr_per_audio_minute": F.when(left > 0, F.lit(PHASE_BUDGET_INR) / left)}).drop("archive_minutes", "committed_inr")


def method_cost(ledger, system, run_days, skipped=("transcribe", "experiment", "qa")):
    """Cost per audio minute of one transcription system: exact, and with everything else paid on its run days."""
    ours = (F.col("stage") == "transcribe") & (F.col("system") == system) & (F.col("status") == "success")
    other = ~ours & F.to_date("recorded_at").cast("string").isin(*run_days) & ~F.col("stage").isin(*skipped)
    sums = ledger.agg((F.sum(F.when(ours, F.col("audio_seconds"))) / 60).alias("minutes"),
                      F.sum(F.when(ours, F.col("external_cost_inr"))).alias("transcription"),
                      F.coalesce(F.sum(F.when(other, F.col("external_cost_inr"))), F.lit(0.0)).alias("other"))
    return sums.select("minutes", (F.col("transcription") / F.col("minutes")).alias("transcription_per_min"),
                       ((F.col("transcription") + F.col("other")) / F.col("minutes")).alias("all_in_upper_per_min"))


def usage_cost(usage, rates):
    """Token usage valued at published rates per million and the budgeting exchange rate; `rates` is a constant table."""
    priced = usage.join(F.broadcast(rates), "system", "left")
    return priced.withColumn("cost_inr", (F.col("input_tokens") * F.col("rate_in") + F.col("output_tokens") * F.col("rate_out")) / 1e6 * FX)
