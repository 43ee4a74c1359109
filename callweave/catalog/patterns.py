"""Buyers and non-buyers: factors, tests, groups, grades."""

from pyspark.sql import functions as F

from ..functions.rules import evidence_display
from ..operators.journeys import pre_purchase
from ..operators.small import unpivot_struct
from ..plans import patterns as pt
from ..sources.bindings import ctes
from .base import query, rounded
from .journeys import OUTCOMES, PRE_SQL

CUT = "1998-07-01"  # leads first called before it are graded, later ones are the check
BASE = ctes("calls", "items", "profiles", "profile_refs")

_kinds = lambda names: "(" + ", ".join(f"'{n}'" for n in names) + ")"
_FLAGS = ",\n".join([f"coalesce(bool_or(collection = 'signals' and label in {_kinds(v)}), false) as {pt.slug(k)}" for k, v in pt.SIGNAL_FACTORS.items()]
                    + [f"coalesce(bool_or(collection = 'objections' and label in {_kinds(v)}), false) as {pt.slug(k)}" for k, v in pt.OBJECTION_FACTORS.items()]
                    + [f"coalesce(bool_or(collection = 'objections' and resolution <> 'resolved'), false) as {pt.slug(pt.UNRESOLVED)}"])
_NAMES = [*pt.SIGNAL_FACTORS, *pt.OBJECTION_FACTORS, pt.UNRESOLVED]
_DECLINE = pt.slug("Said not interested or not a fit")
_EXCL = "(fresher = 'yes' or background = 'non_it' or career_gap = 'over_1_year')"
RECORDS = f"""{OUTCOMES}, {PRE_SQL}, flags as (select p.lead, p.call_id, p.created_on, {_FLAGS} from pre p left join items i on i.call_id = p.call_id group by all),
journey as (select lead, count(*) as pre_calls, {', '.join(f'bool_or({pt.slug(n)}) as {pt.slug(n)}' for n in _NAMES)},
  arg_max({_DECLINE}, strftime(created_on, '%Y%m%d%H%M%S') || call_id) as last_declined, max(created_on) as last_pre from flags group by lead),
records0 as (select o.*, c.first_call, j.* exclude (lead), p.* exclude (lead), p.lead is not null as profiled,
  case when p.lead is not null then {_EXCL} end as {pt.slug(pt.EXCLUDED)}, pre_calls >= 2 as {pt.slug(pt.SEVERAL)},
  case background when 'it' then true when 'non_it' then false end as {pt.slug('IT background')},
  case when motivation <> 'unknown' then motivation = 'switch_into_data_field' end as {pt.slug('Switching into data from another role')},
  case when current_role_group <> 'unknown' then current_role_group in ('data_engineering', 'data_analytics_bi', 'data_science_ml') end
    as {pt.slug('Already works in a data role')},
  experience_years >= 5 as {pt.slug("5+ years' experience")}, experience_years < 2 as {pt.slug("Under 2 years' experience")},
  case employment when 'not_working' then true when 'employed' then false end as {pt.slug('Not working at present')},
  case location_group when 'abroad' then true when 'india' then false end as {pt.slug('Based outside India')}
  from outcomes o join (select lead, min(created_on) as first_call from calls group by lead having max(duration_seconds) >= 180) c on c.lead = o.lead
  left join journey j on j.lead = o.lead left join profiles p on p.lead = o.lead),
records as (select *, all_yes as buyer, case when {pt.slug(pt.EXCLUDED)} then 'Not target' when pre_calls is null then null when last_declined then 'Declined'
  when {pt.slug('Said they would pay or register')} then 'Committed'
  when {pt.slug('Agreed a next call or step')} or {pt.slug('Asked for a demo or sample')} then 'Engaged' else 'Other contacted' end as grp from records0),
study as (select * from records where all_yes or not any_yes)"""
W = 1448 / 150


def rate_sql(b, o):
    z = lambda s: f"1 / (1 + exp(-(ln(case when least({b}, {o}) = 0 then {b} + 0.5 else {b} end / ({W} * case when least({b}, {o}) = 0 then {o} + 0.5 else {o} end)) {s} 1.96 * sqrt(1 / case when least({b}, {o}) = 0 then {b} + 0.5 else {b} end + 1 / case when least({b}, {o}) = 0 then {o} + 0.5 else {o} end))))"
    some = f"({b} + {o}) > 0"
    return (f"case when {some} then {b} / ({b} + {W} * {o}) end", f"case when {some} then {z('-')} end", f"case when {some} then {z('+')} end")


def quoted(label):
    return label.replace("'", "''")


FACTS = "facts as (" + " union all ".join(f"select lead, buyer, '{quoted(n)}' as factor, {pt.slug(n)} as value from study" for n in pt.FACTORS) + ")"
_r, _lo, _hi = rate_sql("a::double", "b::double")
_rw, _, _ = rate_sql("c::double", "d::double")
FACTOR = f"""cells as (select factor, count(*) filter (buyer and value) as a, count(*) filter (not buyer and value) as b,
  count(*) filter (buyer and not value) as c, count(*) filter (not buyer and not value) as d from facts where value is not null group by factor),
factors as (select factor, a as buyers_with, b as non_buyers_with, c as buyers_without, d as non_buyers_without,
  a / nullif(a + c, 0) as buyer_share, b / nullif(b + d, 0) as non_buyer_share, {_r} as rate_with, {_lo} as rate_low, {_hi} as rate_high,
  {_rw} as rate_without, 100 * ({_r} - {_rw}) as difference_pp, exp(lo) as odds_ratio, exp(lo - 1.96 * se) as odds_low, exp(lo + 1.96 * se) as odds_high
  from (select *, ln(((a + 0.5) * (d + 0.5)) / ((b + 0.5) * (c + 0.5))) as lo,
    sqrt(1 / (a + 0.5) + 1 / (b + 0.5) + 1 / (c + 0.5) + 1 / (d + 0.5)) as se from cells) where least(a + b, c + d) > 0)"""
_FACTOR_COLUMNS = ("buyer_share", "non_buyer_share", "rate_with", "rate_low", "rate_high", "rate_without", "difference_pp", "odds_ratio", "odds_low", "odds_high")
FACTOR_OUT = "factor, buyers_with, non_buyers_with, buyers_without, non_buyers_without, " + ", ".join(f"round({c}, 6) as {c}" for c in _FACTOR_COLUMNS)
_lc = lambda n, k: f"(lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - {k} + 1))"
TESTS = f"""sup as (select factor, a, a + b as r, a + c as col, a + b + c + d as n, unnest(generate_series(greatest(0, b * 0 + (a + b) + (a + c) - (a + b + c + d)),
    least(a + b, a + c))) as k from cells where least(a + b, c + d) > 0),
lps as (select *, {_lc('col', 'k')} + {_lc('(n - col)', '(r - k)')} - {_lc('n', 'r')} as lp,
  {_lc('col', 'a')} + {_lc('(n - col)', '(r - a)')} - {_lc('n', 'r')} as lo from sup),
ps as (select factor, least(1.0, sum(exp(lp)) filter (lp <= lo + ln(1 + 1e-7))) as p from lps group by factor),
ranked as (select *, row_number() over (order by p, factor) as i, count(*) over () as m from ps),
tested as (select factor, p, least(1.0, min(p * m / i) over (order by i desc rows unbounded preceding)) as p_adjusted from ranked)"""


def records(t):
    return pt.lead_records(t.calls, t.items, t.profiles)


@query("lead_facts", f"with {BASE}, {RECORDS}, {FACTS} select lead, buyer, factor, value from facts")
def lead_facts(t):
    return pt.facts_long(pt.study(records(t))).select("lead", "buyer", "factor", "value")


@query("lead_groups", f"""with {BASE}, {RECORDS} select lead, all_yes, any_yes, grp as lead_group, cast(first_call as date) as first_call,
 cast(last_pre as date) as last_pre, pre_calls from records""")
def lead_groups(t):
    return records(t).select("lead", "all_yes", "any_yes", F.col("group").alias("lead_group"), F.to_date("first_call").alias("first_call"),
                             F.to_date("last_pre").alias("last_pre"), "pre_calls")


@query("factor_table", f"with {BASE}, {RECORDS}, {FACTS}, {FACTOR} select {FACTOR_OUT} from factors")
def factor_table(t):
    return rounded(pt.factor_table(pt.study(records(t))))


@query("factor_fisher_bh", f"""with {BASE}, {RECORDS}, {FACTS}, {FACTOR}, {TESTS}
 select factor, round(p, 8) as p, round(p_adjusted, 8) as p_adjusted, p_adjusted < 0.05 as clear from tested""")
def factor_fisher_bh(t):
    return rounded(pt.with_tests(pt.factor_table(pt.study(records(t)))).select("factor", "p", "p_adjusted", "clear"), 8)


def grade_sql(source):
    r, lo, hi = rate_sql("buyers::double", "non_buyers::double")
    base, _, _ = rate_sql("bb::double", "oo::double")
    return f"""(select grp, buyers, non_buyers, {r} as rate, {lo} as low, {hi} as high, {base} as base_rate,
   case when grp = 'Not target' then 'Not target' when buyers + non_buyers < 15 then 'Insufficient evidence'
     when {lo} > {base} then 'Hot' when {hi} < {base} then 'Cold' else 'Warm' end as category
   from (select g.grp, count(*) filter (s.buyer) as buyers, count(*) filter (not s.buyer) as non_buyers
     from (values ('Committed'), ('Engaged'), ('Other contacted'), ('Declined'), ('Not target')) g(grp) left join {source} s on s.grp = g.grp group by 1) x,
   (select count(*) filter (buyer) as bb, count(*) filter (not buyer) as oo from {source} where grp is not null and grp <> 'Not target') y)"""


@query("group_grades", f"""with {BASE}, {RECORDS}, dev as (select * from study where first_call < '{CUT}')
 select grp as lead_group, buyers, non_buyers, round(rate, 6) as rate, round(low, 6) as low, round(high, 6) as high, round(base_rate, 6) as base_rate, category
 from {grade_sql('dev')}""")
def group_grades(t):
    graded = pt.grades(pt.study(records(t)).filter(F.col("first_call") < CUT))
    return rounded(graded.withColumnRenamed("group", "lead_group"))


@query("later_period_check", f"""with {BASE}, {RECORDS}, dev as (select * from study where first_call < '{CUT}'), g as (select * from {grade_sql('dev')})
 select count(*) filter (s.grp in (select grp from g where category = 'Hot')) as buyers_in_hot_groups, count(*) as buyers_grouped
 from study s where first_call >= '{CUT}' and buyer and grp is not null and grp <> 'Not target'""")
def later_period_check(t):
    return pt.later_check(pt.study(records(t)), CUT)


def _trait_case(field, labels):
    return f"case {field} " + " ".join(f"when '{k}' then '{quoted(v)}'" for k, v in labels.items()) + " end"


_TRAITS = [(title, _trait_case(f, labels)) for f, (title, labels) in pt.TRAITS.items()] + [("Experience", """case when experience_years < 2 then 'Under 2 years'
  when experience_years < 5 then '2-5 years' when experience_years < 10 then '5-10 years' when experience_years is not null then '10+ years' end""")]


@query("trait_shares", f"""with {BASE}, {RECORDS}, long as ({' union all '.join(f"select buyer, '{title}' as trait, {case} as value from study where profiled" for title, case in _TRAITS)}),
 c as (select trait, value, count(*) filter (buyer) as buyers, count(*) filter (not buyer) as non_buyers from long where value is not null group by 1, 2),
 k as (select *, cast(sum(buyers) over (partition by trait) as bigint) as buyers_known, cast(sum(non_buyers) over (partition by trait) as bigint) as non_buyers_known from c)
 select *, round(buyers / buyers_known, 6) as buyer_share, round(non_buyers / non_buyers_known, 6) as non_buyer_share from k""")
def trait_shares(t):
    return rounded(pt.trait_shares(pt.study(records(t))))


EVIDENCE = f"""cited as (select r.lead, r.field from profile_refs r join pre p on p.lead = r.lead and p.call_id = r.call_id),
fits as (select lead, case when
   (background = 'non_it' and exists (select 1 from cited c where c.lead = p.lead and c.field = 'background'))
   or (fresher = 'yes' and exists (select 1 from cited c where c.lead = p.lead and c.field = 'fresher'))
   or (career_gap = 'over_1_year' and exists (select 1 from cited c where c.lead = p.lead and c.field = 'career_gap'))
   or (employment = 'student' and exists (select 1 from cited c where c.lead = p.lead and c.field = 'employment'))
   or (current_role_group in ('non_it', 'student') and exists (select 1 from cited c where c.lead = p.lead and c.field = 'current_role_group'))
   then 'outside' else 'in_or_unknown' end as fit from profiles p),
lastlong as (select f.*, row_number() over (partition by f.lead order by f.created_on desc, f.call_id desc) as rn
  from flags f join calls c on c.call_id = f.call_id where c.duration_seconds >= 180),
past as (select case when fit = 'outside' then 'Outside target' when {pt.slug('Said they would pay or register')} and not {_DECLINE} then 'Hot'
   when {_DECLINE} then 'Cold: declined' else 'Warm' end as category, all_yes
  from lastlong l join outcomes o on o.lead = l.lead left join fits f on f.lead = l.lead where rn = 1 and (all_yes or not any_yes)),
evidence as (select category, count(*) filter (all_yes) as customers, count(*) filter (not all_yes) as non_buyers_sampled from past group by category)"""
_er, _el, _eh = rate_sql("customers::double", "non_buyers_sampled::double")


@query("past_lead_evidence", f"""with {BASE}, {RECORDS}, {EVIDENCE} select *, round({_er}, 6) as rate, round({_el}, 6) as low, round({_eh}, 6) as high from evidence""")
def past_lead_evidence(t):
    return rounded(pt.past_lead_evidence(t.calls, t.items, t.profiles, t.profile_refs))


@query("profile_fit", f"with {BASE}, {RECORDS}, {EVIDENCE} select lead, fit from fits")
def profile_fit(t):
    return pt.fit(pre_purchase(t.calls), t.profiles, t.profile_refs)


@query("profile_fit_of_leads", f"with {BASE}, {RECORDS}, {EVIDENCE} select lead, case when lead::bigint % 5 = 0 then 'unknown' else fit end as fit from fits")
def profile_fit_of_leads(t):
    """Every fifth lead has no profile here."""
    profiles = t.profiles.where(F.col("lead").cast("bigint") % 5 > 0)
    return pt.fit_of(t.profiles, pt.fit(pre_purchase(t.calls), profiles, t.profile_refs))


@query("evidence_display", f"""with {BASE}, {RECORDS}, {EVIDENCE}, e as (select *, {_er} as rate, {_el} as low, {_eh} as high from evidence)
 select category, customers, non_buyers_sampled, case when category = 'Hot' then 'Not shown: for most past customers this was said on the call where they paid'
  when customers < 10 or non_buyers_sampled < 5 then 'Too few past cases for a reliable rate'
  else printf('%.1f in 10 bought (range %.1f–%.1f)', rate * 10, low * 10, high * 10) end as shown,
  round((select sum(customers) / (sum(customers) + {W} * sum(non_buyers_sampled)) from evidence), 6) as base_rate from e""")
def evidence_display_query(t):
    from pyspark.sql import Window
    e = pt.past_lead_evidence(t.calls, t.items, t.profiles, t.profile_refs)
    whole = Window.partitionBy()  # at most four rows
    base = F.sum("customers").over(whole) / (F.sum("customers").over(whole) + W * F.sum("non_buyers_sampled").over(whole))
    return rounded(e.select("category", "customers", "non_buyers_sampled", evidence_display(
        F.col("category"), F.col("customers"), F.col("non_buyers_sampled"), F.col("rate"), F.col("low"), F.col("high")).alias("shown"), base.alias("base_rate")))


@query("lead_cards", f"""with {BASE}, {RECORDS}, {FACTS}, {FACTOR}, {TESTS}, dev as (select * from study where first_call < '{CUT}'), g as (select * from {grade_sql('dev')}),
 pooled as (select grp, rate, buyers + non_buyers as n from {grade_sql('study')}),
 allfacts as ({" union all ".join(f"select lead, '{quoted(n)}' as factor, {pt.slug(n)} as value from records" for n in pt.FACTORS)}),
 notes as (select lead, string_agg(note, '; ' order by note) as other_factors from (select a.lead, a.factor || ' (' || case when f.odds_ratio > 1 then 'buyers more likely'
    else 'buyers less likely' end || ')' as note from allfacts a join tested t on t.factor = a.factor join factors f on f.factor = a.factor
    where a.value and t.p_adjusted < 0.05 and a.factor not in ('Said they would pay or register', 'Said not interested or not a fit', '{pt.EXCLUDED}')) group by lead),
 concerns as (select lead, string_agg(c, '; ' order by c) as open_concerns from (select distinct p.lead, replace(i.label, '_', ' ') as c from pre p join items i on i.call_id = p.call_id
    where i.collection = 'objections' and i.resolution <> 'resolved') group by lead)
 select r.lead, case when all_yes then 'customer' when any_yes then 'mixed' else 'open' end as crm, r.grp as lead_group,
  case when r.grp is null then 'Not reached' else g.category end as category,
  case r.grp when 'Committed' then 'Said they would pay or register' when 'Engaged' then 'Agreed a next call or asked for a demo, but did not commit to paying'
    when 'Other contacted' then 'Had a sales conversation without a commitment, decline or agreed next step'
    when 'Declined' then 'Said they were not interested in their latest sales conversation'
    when 'Not target' then '{pt.EXCLUDED}: ' || concat_ws(', ', case when fresher = 'yes' then 'Fresher' end, case when background = 'non_it' then 'Non-IT background' end,
      case when career_gap = 'over_1_year' then 'Career gap over a year' end) else 'No sales conversation in the recorded calls' end as reasons,
  coalesce(other_factors, '') as other_factors, coalesce(open_concerns, '') as open_concerns, round(pooled.rate, 6) as group_rate, pooled.n as group_leads,
  cast(last_pre as date) as last_sales_conversation, r.calls
 from records r left join g on g.grp = r.grp left join pooled on pooled.grp = r.grp left join notes on notes.lead = r.lead left join concerns on concerns.lead = r.lead""")
def lead_cards(t):
    cards = pt.lead_cards(t.calls, t.items, records(t), CUT).withColumnRenamed("group", "lead_group")
    return rounded(cards.withColumn("last_sales_conversation", F.to_date("last_sales_conversation")))


@query("profile_exclusions", f"""with {ctes('profiles')} select lead, concat_ws(', ', case when fresher = 'yes' then 'Fresher' end,
 case when background = 'non_it' then 'Non-IT background' end, case when career_gap = 'over_1_year' then 'Career gap over a year' end) as exclusions from profiles""")
def profile_exclusions(t):
    return t.profiles.select("lead", F.array_join(pt.exclusion_labels(), ", ").alias("exclusions"))


_CHECK = (("background", "background"), ("fresher", "fresher"), ("career_gap", "career_gap"), ("employment", "employment"), ("current_role_group", "current_role_group"))


@query("profile_citation_check", f"""with {ctes('calls', 'lines', 'profiles', 'profile_refs')},
 shown as (select c.lead, l.call_id, l.segment_id from lines l join calls c using (call_id) where c.conversation_type not in ('unusable', 'unclear')),
 long as ({' union all '.join(f"select lead, '{n}' as field, {f} as value from profiles" for f, n in _CHECK)})
 select r.lead, field, 'reference ' || r.call_id || '#' || r.segment_id || ' is not one of the shown lines' as problem from profile_refs r
   where not exists (select 1 from shown s where s.lead = r.lead and s.call_id = r.call_id and s.segment_id = r.segment_id)
 union all select lead, field, 'a known value needs evidence' from long l where value not in ('unknown', 'not_mentioned', '')
   and not exists (select 1 from profile_refs r where r.lead = l.lead and r.field = l.field)""")
def profile_citation_check(t):
    """References must be lines that were shown; a known value needs one."""
    shown = t.lines.join(t.calls.filter(~F.col("conversation_type").isin("unusable", "unclear")).select("call_id", "lead"), "call_id")
    refs = t.profile_refs
    wrong = refs.join(shown.select("lead", "call_id", "segment_id"), ["lead", "call_id", "segment_id"], "left_anti").select(
        "lead", "field", F.concat(F.lit("reference "), "call_id", F.lit("#"), F.col("segment_id").cast("string"),
                                  F.lit(" is not one of the shown lines")).alias("problem"))
    long = unpivot_struct(t.profiles, ["lead"], [(n, F.col(f)) for f, n in _CHECK], "field", "value")
    known = long.filter(~F.col("value").isin("unknown", "not_mentioned", ""))
    bare = known.join(refs.select("lead", "field"), ["lead", "field"], "left_anti").select("lead", "field", F.lit("a known value needs evidence").alias("problem"))
    return wrong.unionByName(bare)


@query("profile_citation_text", f"""with {ctes('lines', 'profile_refs')} select r.lead, r.field, r.call_id, r.segment_id, cast(l.start as double) as start, l.text as quote
 from profile_refs r join lines l on l.call_id = r.call_id and l.segment_id = r.segment_id""")
def profile_citation_text(t):
    """The cited words and their time, copied from the lines."""
    return t.profile_refs.join(t.lines, ["call_id", "segment_id"]).select(
        "lead", "field", "call_id", "segment_id", F.col("start").cast("double").alias("start"), F.col("text").alias("quote"))


# Twelve traits, those the tables lack made from what they have, each cited from the calls whose number gives its place.
_TRAITS = """t as (select p.lead, p.experience_years::varchar as experience_years, fresher, background, career_gap, employment, current_role_group, 'company ' || nation as company, location_group,
   case when balance > 0 then balance::varchar end as salary_lpa, case when balance > 5000 then 'unknown' else 'data_engineering' end as target_role_group, motivation,
   case when segment = 'BUILDING' then 'unknown' else 'self' end as buyer_for from profiles p join leads l on l.lead = p.lead)"""


def traits(t):
    from ..operators import schemas
    own = t.profiles.join(t.leads, "lead")
    values = own.select("lead", F.col("experience_years").cast("string").alias("experience_years"), "fresher", "background", "career_gap", "employment", "current_role_group",
                        F.concat(F.lit("company "), "nation").alias("company"), "location_group", F.when(F.col("balance") > 0, F.col("balance").cast("string")).alias("salary_lpa"),
                        F.when(F.col("balance") > 5000, "unknown").otherwise("data_engineering").alias("target_role_group"), "motivation",
                        F.when(F.col("segment") == "BUILDING", "unknown").otherwise("self").alias("buyer_for"))
    ref = lambda i: F.collect_list(F.when(F.col("source_row") % 12 == i, F.struct("call_id", (F.col("source_row") % 5).cast("bigint").alias("segment_id"))))
    refs = t.calls.groupBy("lead").agg(*[ref(i).alias(f"{name}_evidence") for i, (_, _, name) in enumerate(schemas.TRAITS)])
    return values.join(refs, "lead", "left")


_LONG = " union all ".join(f"select lead, {i} as i, '{n}' as trait, {v} as value from t" for i, (v, n) in enumerate(
    [("experience_years", "experience"), ("fresher", "fresher"), ("background", "background"), ("career_gap", "career_gap"), ("employment", "employment"),
     ("current_role_group", "current_role"), ("company", "company"), ("location_group", "location"), ("salary_lpa", "salary"), ("target_role_group", "target_role"),
     ("motivation", "motivation"), ("buyer_for", "buyer_for")]))


@query("profile_trait_citations", f"""with {ctes('calls', 'lines', 'profiles', 'leads')}, {_TRAITS}, long as ({_LONG}), refs as (select lead, source_row % 12 as i, call_id, source_row % 5 as segment_id from calls)
 select lead, trait || ': a known value needs evidence' as problem from long l where value is not null and value not in ('unknown', 'not_mentioned', '')
   and not exists (select 1 from refs r where r.lead = l.lead and r.i = l.i)
 union all select r.lead, trait || ': reference ' || r.call_id || '#' || r.segment_id || ' is not one of the shown lines' from refs r join long l on l.lead = r.lead and l.i = r.i
   where not exists (select 1 from lines s where s.call_id = r.call_id and s.segment_id = r.segment_id)""")
def profile_trait_citations(t):
    """All twelve traits of a profile against the lines they cite."""
    from ..operators import schemas
    shown = t.lines.join(t.calls.select("call_id", "lead"), "call_id").select("lead", "call_id", "segment_id")
    return schemas.trait_citations(traits(t), shown)
