"""First-match rules: ordered CASE expressions whose branches carry their reasons."""

from pyspark.sql import functions as F

# ---- fixed values: the frozen rule ----
RULE = {"version": "worklist-rule-v2", "hot_within_days": 45, "dormant_after_days": 90, "min_conversation_seconds": 180}
CATEGORIES = ("Hot", "Warm", "Check status", "Recording unusable: confirm status", "Dormant: reconfirm", "Cold: declined",
              "Outside target", "Not reached")
# ---- end of fixed values ----


def first_match(branches, otherwise):
    """(category, reason) columns of the first branch whose condition is true."""
    category = reason = None
    for condition, name, why in branches:
        why = F.lit(why) if isinstance(why, str) else why
        category = F.when(condition, name) if category is None else category.when(condition, name)
        reason = F.when(condition, why) if reason is None else reason.when(condition, why)
    last = otherwise[1]
    return category.otherwise(otherwise[0]), reason.otherwise(F.lit(last) if isinstance(last, str) else last)


def categorise(as_of, company="the company", rule=RULE):
    """The worklist rule over a coding frame with live_date and attempts_since; `as_of` is a date column."""
    c = F.col
    days = F.date_diff(as_of, c("live_date"))
    since = F.concat(days.cast("string"), F.lit(" days before the data cutoff"))
    conditional = c("stance") == "conditional_commitment"
    committed = (c("stance") == "commitment") | (conditional & F.coalesce(c("condition_can_be_met") == "yes", F.lit(False)))
    tries = c("attempts_since")
    return first_match([
        (c("status_needed"), "Check status", c("status_reason")),
        (c("stance") == "recording_unusable", "Recording unusable: confirm status",
         "The recorded calls have no usable audio, so nothing is known"),
        (c("stance") == "none", "Not reached", F.concat(F.lit("No conversation in "), tries.cast("string"), F.lit(" recorded call"),
                                                       F.when(tries == 1, "").otherwise("s"))),
        (c("target_value") == "outside_target", "Outside target", c("target_reason")),
        (c("stance").isin("declined", "product_not_sold"), "Cold: declined", c("detail")),
        (conditional & F.coalesce(c("condition_can_be_met") == "no", F.lit(False)), "Cold: declined",
         F.concat(F.lit(f"Condition {company} cannot meet: "), c("condition"))),
        (committed & ~c("refused_after_commitment") & F.coalesce(days <= rule["hot_within_days"], F.lit(False)), "Hot",
         F.concat(c("detail"), F.coalesce(F.concat(F.lit(" (condition: "), c("condition"), F.lit(")")), F.lit("")), F.lit("; "), since)),
        (F.coalesce(days > rule["dormant_after_days"], F.lit(False)), "Dormant: reconfirm",
         F.concat(F.lit("Last conversation "), since, F.lit("; information is stale"))),
        (committed, "Warm", F.concat(F.lit("Re-open: commitment from "), F.coalesce(since, F.lit("")))),
    ], ("Warm", c("detail")))


def category_order(category):
    expr = None
    for i, name in enumerate(CATEGORIES):
        expr = F.when(category == name, i) if expr is None else expr.when(category == name, i)
    return expr


def priority_label():
    """Workflow label over journey flags (never a probability). Columns: any_dnc, any_yes, complete, has_live, live_type and
    the flags live_payment_intent, live_urgency, live_demo, live_followup, live_cold, live_warm of the last live call."""
    c = F.col
    flag = lambda name: F.coalesce(c(name), F.lit(False))
    return first_match([
        (flag("any_dnc"), "Do not contact", "A recorded request to stop contact needs to be respected."),
        (flag("any_yes"), "Verify enrollment", "CRM contains a Yes flag; confirm enrollment before further sales follow-up."),
        (~flag("complete"), "Needs review", "The selected journey has calls without validated extraction."),
        (~flag("has_live"), "No live conversation", "Every recorded call reached voicemail or had no usable conversation."),
        (c("live_type").isin("learner_support", "administrative"), "Service follow-up",
         "The last live conversation concerns learner support or administration."),
        (flag("live_payment_intent") | (flag("live_urgency") & (flag("live_demo") | flag("live_followup"))), "Hot signal",
         "The last live conversation contains an explicit purchase or urgent next-step signal."),
        (flag("live_cold"), "Cold signal", "The last live conversation contains an explicit lack of interest or fit."),
        (flag("live_warm"), "Warm signal", "The last live conversation contains a goal, product question or agreed next step."),
    ], ("Unclassified", "The last live conversation does not support a clear buying-temperature label."))


def group_of():
    """Operational group over excluded, has_pre, last_declined, committed, engaged."""
    c = F.col
    return (F.when(c("excluded"), "Not target").when(~c("has_pre"), None).when(c("last_declined"), "Declined")
            .when(c("committed"), "Committed").when(c("engaged"), "Engaged").otherwise("Other contacted"))


def experience_band(years):
    return (F.when(years < 2, "Under 2 years").when(years < 5, "2-5 years").when(years < 10, "5-10 years")
            .when(years.isNotNull(), "10+ years"))


def evidence_display(category, customers, non_buyers, rate, low, high):
    """What a report may show of a group's past rate."""
    tenth = lambda v: F.format_string("%.1f", v * 10)
    return (F.when(category == "Hot", "Not shown: for most past customers this was said on the call where they paid")
            .when((customers < 10) | (non_buyers < 5), "Too few past cases for a reliable rate")
            .otherwise(F.concat(tenth(rate), F.lit(" in 10 bought (range "), tenth(low), F.lit("–"), tenth(high), F.lit(")"))))
