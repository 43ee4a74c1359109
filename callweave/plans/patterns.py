"""Buyers against non-buyers: factors, exact tests, groups and grades, read only up to the purchase boundary."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.rules import RULE, experience_band, group_of
from ..operators.journeys import crm_status, eligible, moment, outcomes, pre_purchase
from ..operators.small import case_of, constants, unpivot_struct

# ---- fixed values: study design and factor labels ----
OPEN_POPULATION, OPEN_SAMPLE = 1448, 150
MIN_GROUP = 15
SIGNAL_FACTORS = {"Said they would pay or register": ("payment_intent",), "Agreed a next call or step": ("followup_agreed",),
                  "Asked about the fee": ("price_question",), "Asked for a demo or sample": ("demo_requested",),
                  "Said they need it soon": ("urgency",),
                  "Said not interested or not a fit": ("low_interest", "not_a_fit", "do_not_contact"),
                  "Said they have no time": ("no_time",)}
OBJECTION_FACTORS = {"Raised price": ("price",), "Raised the course format (live or recorded, schedule)": ("format",),
                     "Raised course fit or content": ("course_fit",), "Raised timing or availability": ("timing", "time"),
                     "Raised job outcomes": ("career_outcomes",), "Raised prerequisites": ("prerequisites",),
                     "Needs someone else's approval": ("decision_maker",), "Raised trust": ("trust",)}
DECLINE = SIGNAL_FACTORS["Said not interested or not a fit"]
EXCLUSIONS = {"fresher": ("yes", "Fresher"), "background": ("non_it", "Non-IT background"),
              "career_gap": ("over_1_year", "Career gap over a year")}
GROUPS = ("Committed", "Engaged", "Other contacted", "Declined", "Not target")
UNRESOLVED, SEVERAL = "A concern was left unresolved", "Two or more sales conversations"
EXCLUDED = "Matches a target exclusion"
GROUP_REASONS = {"Committed": "Said they would pay or register",
                 "Engaged": "Agreed a next call or asked for a demo, but did not commit to paying",
                 "Other contacted": "Had a sales conversation without a commitment, decline or agreed next step",
                 "Declined": "Said they were not interested in their latest sales conversation"}
TRAITS = {
    "motivation": ("Main reason for the course", {
        "switch_into_data_field": "Switching into data from another role", "grow_in_current_data_role": "Growing in a current data role",
        "better_salary_or_job": "Better salary or job", "find_a_job": "Looking for a job",
        "skills_for_current_project": "Skills for a current project", "buying_for_team": "Buying for a team", "other": "Other reason"}),
    "current_role_group": ("Current role", {
        "software_developer": "Software developer", "testing_qa": "Testing / QA", "data_analytics_bi": "Data analyst / BI",
        "data_engineering": "Data engineer", "data_science_ml": "Data science / ML", "cloud_devops": "Cloud / DevOps",
        "database_admin": "Database administrator", "it_support_operations": "IT support / operations",
        "other_it": "Other IT role", "non_it": "Outside IT", "student": "Student"}),
    "background": ("Background", {"it": "IT", "non_it": "Outside IT"}),
    "employment": ("Working now", {"employed": "Working", "not_working": "Not working", "student": "Student"}),
    "location_group": ("Location", {"india": "India", "abroad": "Outside India"})}
# ---- end of fixed values ----


def slug(label):
    return "f_" + "".join(ch if ch.isalnum() else "_" for ch in label.lower())


def call_flags(items):
    """One row per call with a flag per signal and objection factor. Items are combined map-side before the shuffle."""
    signal, objection = F.col("collection") == "signals", F.col("collection") == "objections"
    flags = [F.some(signal & F.col("label").isin(*kinds)).alias(slug(name)) for name, kinds in SIGNAL_FACTORS.items()]
    flags += [F.some(objection & F.col("label").isin(*kinds)).alias(slug(name)) for name, kinds in OBJECTION_FACTORS.items()]
    flags.append(F.some(objection & (F.col("resolution") != "resolved")).alias(slug(UNRESOLVED)))
    return items.groupBy("call_id").agg(*flags)


def exclusion_labels():
    return F.array_compact(F.array(*[F.when(F.col(f) == value, label) for f, (value, label) in EXCLUSIONS.items()]))


def _profile_factors():
    c = F.col
    known = lambda column, value: F.when(c(column).isNotNull() & (c(column) != "unknown"), value)
    return {
        EXCLUDED: F.when(c("profiled"), F.size(exclusion_labels()) > 0),
        "IT background": F.when(c("background") == "it", True).when(c("background") == "non_it", False),
        "Switching into data from another role": known("motivation", c("motivation") == "switch_into_data_field"),
        "Already works in a data role": known("current_role_group", c("current_role_group").isin(
            "data_engineering", "data_analytics_bi", "data_science_ml")),
        "5+ years' experience": c("experience_years") >= 5, "Under 2 years' experience": c("experience_years") < 2,
        "Not working at present": F.when(c("employment") == "not_working", True).when(c("employment") == "employed", False),
        "Based outside India": F.when(c("location_group") == "abroad", True).when(c("location_group") == "india", False)}


FACTORS = [*SIGNAL_FACTORS, *OBJECTION_FACTORS, UNRESOLVED, SEVERAL, EXCLUDED, "IT background",
           "Switching into data from another role", "Already works in a data role", "5+ years' experience",
           "Under 2 years' experience", "Not working at present", "Based outside India"]


def lead_records(calls, items, profiles, min_seconds=180):
    """One row per eligible lead: buyer, first call, factor columns (true / false / null), group."""
    names = [*SIGNAL_FACTORS, *OBJECTION_FACTORS, UNRESOLVED]
    pre = pre_purchase(calls).join(call_flags(items), "call_id", "left")
    flag = lambda name: F.coalesce(F.col(slug(name)), F.lit(False))
    decline = slug("Said not interested or not a fit")
    journey = pre.groupBy("lead").agg(
        F.count(F.lit(1)).alias("pre_calls"), *[F.some(flag(n)).alias(slug(n)) for n in names],
        F.max_by(F.coalesce(F.col(decline), F.lit(False)), moment()).alias("last_declined"), F.max("created_on").alias("last_pre"))
    leads = outcomes(calls).join(eligible(calls, min_seconds), "lead")
    leads = leads.join(calls.groupBy("lead").agg(F.min("created_on").alias("first_call")), "lead")
    leads = leads.join(journey, "lead", "left").join(profiles.withColumn("profiled", F.lit(True)), "lead", "left")
    leads = leads.withColumns({slug(n): v for n, v in _profile_factors().items()} | {
        slug(SEVERAL): F.col("pre_calls") >= 2, "profiled": F.coalesce(F.col("profiled"), F.lit(False)),
        "has_pre": F.col("pre_calls").isNotNull()})
    leads = leads.withColumns({
        "excluded": F.coalesce(F.col(slug(EXCLUDED)), F.lit(False)), "committed": flag("Said they would pay or register"),
        "engaged": flag("Agreed a next call or step") | flag("Asked for a demo or sample"), "buyer": F.col("all_yes"),
        "last_declined": F.coalesce("last_declined", F.lit(False))})
    return leads.withColumn("group", group_of())


def study(records):
    """Buyers (all Yes) and non-buyers (no Yes); mixed flags are left out."""
    return records.filter(F.col("all_yes") | ~F.col("any_yes"))


def facts_long(records):
    return unpivot_struct(records, ["lead", "buyer"], [(n, F.col(slug(n))) for n in FACTORS], "factor", "value")


def factor_table(records, sample=OPEN_SAMPLE, population=OPEN_POPULATION):
    """2x2 counts and effect sizes per factor; leads with an unknown value leave that factor's denominator."""
    known = facts_long(records).filter(F.col("value").isNotNull())
    cell = lambda buyer, value: F.count_if((F.col("buyer") == buyer) & (F.col("value") == value))
    counts = known.groupBy("factor").agg(cell(True, True).alias("buyers_with"), cell(False, True).alias("non_buyers_with"),
                                         cell(True, False).alias("buyers_without"), cell(False, False).alias("non_buyers_without"))
    a, b, c, d = (F.col(x) for x in ("buyers_with", "non_buyers_with", "buyers_without", "non_buyers_without"))
    counts = counts.filter(F.least(a + b, c + d) > 0)
    rate, low, high = stats.conversion_rate(a, b, sample, population)
    without, _, _ = stats.conversion_rate(c, d, sample, population)
    ratio, ratio_low, ratio_high = stats.odds_ratio(a, b, c, d)
    return counts.withColumns({"buyer_share": F.try_divide(a, a + c), "non_buyer_share": F.try_divide(b, b + d), "rate_with": rate,
                               "rate_low": low, "rate_high": high, "rate_without": without, "difference_pp": 100 * (rate - without),
                               "odds_ratio": ratio, "odds_low": ratio_low, "odds_high": ratio_high})


def with_tests(factors):
    """Fisher's exact p and the Benjamini-Hochberg adjustment over the factor table (a few dozen rows)."""
    p = stats.fisher_p(factors, "factor", "buyers_with", "non_buyers_with", "buyers_without", "non_buyers_without")
    rows = factors.join(p, "factor")
    rows = rows.withColumns({"__i": F.row_number().over(Window.orderBy("p", "factor")), "__m": F.count(F.lit(1)).over(Window.partitionBy())})
    from_here = Window.orderBy(F.col("__i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("p_adjusted", F.least(F.lit(1.0), F.min(F.col("p") * F.col("__m") / F.col("__i")).over(from_here)))
    return rows.withColumn("clear", F.col("p_adjusted") < 0.05).drop("__i", "__m").orderBy("p", "factor")


def grades(records, sample=OPEN_SAMPLE, population=OPEN_POPULATION):
    """All five groups, graded against the overall rate of the targeted, grouped leads."""
    counts = records.filter(F.col("group").isNotNull()).groupBy("group").agg(F.count_if("buyer").alias("buyers"),
                                                                            F.count_if(~F.col("buyer")).alias("non_buyers"))
    names = constants(records.sparkSession, [(g,) for g in GROUPS], "group string")
    rows = names.join(counts, "group", "left").na.fill(0, ["buyers", "non_buyers"])
    graded = F.col("group") != "Not target"
    everyone = Window.partitionBy()  # five rows
    base_b, base_o = (F.sum(F.when(graded, F.col(x)).otherwise(0)).over(everyone) for x in ("buyers", "non_buyers"))
    rows = rows.withColumns({"__b": base_b, "__o": base_o})
    base, _, _ = stats.conversion_rate(F.col("__b"), F.col("__o"), sample, population)
    rate, low, high = stats.conversion_rate(F.col("buyers"), F.col("non_buyers"), sample, population)
    rows = rows.withColumns({"rate": rate, "low": low, "high": high, "base_rate": base})
    category = (F.when(~graded, "Not target").when((F.col("buyers") + F.col("non_buyers") < MIN_GROUP) | F.col("low").isNull(),
                                                   "Insufficient evidence")
                .when(F.col("low") > F.col("base_rate"), "Hot").when(F.col("high") < F.col("base_rate"), "Cold").otherwise("Warm"))
    return rows.withColumn("category", category).drop("__b", "__o")


def later_check(records, cut):
    """Buyers first called from `cut` on, and how many of them are in groups graded Hot before it."""
    hot = grades(records.filter(F.col("first_call") < cut)).filter(F.col("category") == "Hot").select("group", F.lit(True).alias("hot"))
    later = records.filter((F.col("first_call") >= cut) & F.col("buyer") & F.col("group").isNotNull() & (F.col("group") != "Not target"))
    return later.join(F.broadcast(hot), "group", "left").agg(F.count_if("hot").alias("buyers_in_hot_groups"),
                                                             F.count(F.lit(1)).alias("buyers_grouped"))


def trait_shares(records):
    """Shares of each known profile value among profiled buyers and non-buyers."""
    pairs = [(title, case_of(F.col(f), labels)) for f, (title, labels) in TRAITS.items()]
    pairs.insert(2, ("Experience", experience_band(F.col("experience_years"))))
    long = unpivot_struct(records.filter("profiled"), ["buyer"], pairs, "trait", "value").filter(F.col("value").isNotNull())
    rows = long.groupBy("trait", "value").agg(F.count_if("buyer").alias("buyers"), F.count_if(~F.col("buyer")).alias("non_buyers"))
    whole = Window.partitionBy("trait")  # at most a dozen rows per trait
    rows = rows.withColumns({"buyers_known": F.sum("buyers").over(whole), "non_buyers_known": F.sum("non_buyers").over(whole)})
    return rows.withColumns({"buyer_share": F.try_divide("buyers", "buyers_known"),
                             "non_buyer_share": F.try_divide("non_buyers", "non_buyers_known")})


def fit(pre, profiles, refs):
    """outside / in_or_unknown / unknown per lead; a profile value counts only when a pre-purchase call is cited for it."""
    cited = refs.join(pre.select("lead", "call_id"), ["lead", "call_id"], "left_semi")
    fields = ("background", "fresher", "career_gap", "employment", "current_role_group")
    seen = cited.groupBy("lead").agg(*[F.some(F.col("field") == f).alias("cited_" + f) for f in fields])
    rows = profiles.join(seen, "lead", "left")
    known = lambda f, *values: F.coalesce(F.col("cited_" + f) & F.col(f).isin(*values), F.lit(False))
    outside = (known("background", "non_it") | known("fresher", "yes") | known("career_gap", "over_1_year")
               | known("employment", "student") | known("current_role_group", "non_it", "student"))
    return rows.select("lead", F.when(outside, "outside").otherwise("in_or_unknown").alias("fit"))


def fit_of(leads, fits):
    """The fit of every lead; one without a profile is unknown."""
    return leads.select("lead").join(fits, "lead", "left").na.fill("unknown", ["fit"])


def past_lead_evidence(calls, items, profiles, refs, rule=RULE, sample=OPEN_SAMPLE, population=OPEN_POPULATION):
    """Closed past leads by the category the rule would give them at their latest long pre-purchase conversation."""
    pre = pre_purchase(calls)
    flags = call_flags(items).select("call_id", F.col(slug("Said they would pay or register")).alias("pays"),
                                     F.col(slug("Said not interested or not a fit")).alias("declines"))
    long = pre.filter(F.col("duration_seconds") >= rule["min_conversation_seconds"]).join(flags, "call_id", "left")
    last = long.groupBy("lead").agg(F.max_by(F.struct(F.coalesce("pays", F.lit(False)).alias("pays"),
                                                      F.coalesce("declines", F.lit(False)).alias("declines")), moment()).alias("x"))
    leads = last.join(outcomes(calls), "lead").filter(F.col("all_yes") | ~F.col("any_yes")).join(fit(pre, profiles, refs), "lead", "left")
    category = (F.when(F.col("fit") == "outside", "Outside target").when(F.col("x.pays") & ~F.col("x.declines"), "Hot")
                .when(F.col("x.declines"), "Cold: declined").otherwise("Warm"))
    counts = leads.groupBy(category.alias("category")).agg(F.count_if("all_yes").alias("customers"),
                                                           F.count_if(~F.col("all_yes")).alias("non_buyers_sampled"))
    rate, low, high = stats.conversion_rate(F.col("customers"), F.col("non_buyers_sampled"), sample, population)
    return counts.withColumns({"rate": rate, "low": low, "high": high})


def lead_cards(calls, items, records, cut):
    """Per lead: group, category from the development period, pooled rate, clear factors it has and open concerns."""
    graded = grades(study(records).filter(F.col("first_call") < cut)).select("group", F.col("category").alias("graded_category"))
    pooled = grades(study(records)).select("group", F.col("rate").alias("group_rate"),
                                           (F.col("buyers") + F.col("non_buyers")).alias("group_leads"))
    hidden = ("Said they would pay or register", "Said not interested or not a fit", EXCLUDED)
    clear = with_tests(factor_table(study(records))).filter(F.col("clear") & ~F.col("factor").isin(*hidden)).select(
        "factor", F.concat("factor", F.lit(" ("), F.when(F.col("odds_ratio") > 1, "buyers more likely").otherwise("buyers less likely"),
                           F.lit(")")).alias("note"))
    notes = facts_long(records).filter("value").join(F.broadcast(clear), "factor").groupBy("lead").agg(
        F.array_join(F.array_sort(F.collect_set("note")), "; ").alias("other_factors"))  # at most one note per factor
    open_items = items.filter((F.col("collection") == "objections") & (F.col("resolution") != "resolved")).select("call_id", "label")
    concerns = pre_purchase(calls).select("call_id", "lead").join(open_items, "call_id").select(
        "lead", F.replace("label", F.lit("_"), F.lit(" ")).alias("c")).distinct().groupBy("lead").agg(
        F.array_join(F.array_sort(F.collect_set("c")), "; ").alias("open_concerns"))  # at most one per category
    rows = records.join(F.broadcast(graded), "group", "left").join(F.broadcast(pooled), "group", "left")
    rows = rows.join(notes, "lead", "left").join(concerns, "lead", "left")
    reason = F.when(F.col("group").isNull(), "No sales conversation in the recorded calls").when(
        F.col("group") == "Not target", F.concat(F.lit(EXCLUDED + ": "), F.array_join(exclusion_labels(), ", "))).otherwise(
        case_of(F.col("group"), GROUP_REASONS))
    return rows.select("lead", crm_status(F.col("all_yes"), F.col("any_yes"), ("customer", "mixed", "open")).alias("crm"), "group",
                       F.when(F.col("group").isNull(), "Not reached").otherwise(F.col("graded_category")).alias("category"),
                       reason.alias("reasons"), F.coalesce("other_factors", F.lit("")).alias("other_factors"),
                       F.coalesce("open_concerns", F.lit("")).alias("open_concerns"), "group_rate", "group_leads",
                       F.col("last_pre").alias("last_sales_conversation"), "calls")
