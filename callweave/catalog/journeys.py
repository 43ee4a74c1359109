"""Ingest, sampling, cohorts and journeys."""

from pyspark.sql import functions as F

from ..functions.keys import call_key, dataset_digest, digest
from ..operators import ingest, journeys, sampling
from ..operators.sampling import DEFAULT_QUOTAS
from ..sources.bindings import ctes
from .base import query, rounded

HOST = "recordings.example.com"
SEED = "journey-sample-v1"
QUOTA_ROWS = ", ".join(f"({k}, {v})" for k, v in DEFAULT_QUOTAS.items())

VALIDATED = f"""
raw as (select *, trim(coalesce(recording_url, '')) as url from raw_calls),
parts as (select *, regexp_extract(url, '^([a-z]+)://', 1) as proto, regexp_extract(url, '^[a-z]+://([^/]*)', 1) as auth,
  regexp_extract(duration_text, '^(\\d+)h:(\\d+)m:(\\d+)s$', 1) as h, regexp_extract(duration_text, '^(\\d+)h:(\\d+)m:(\\d+)s$', 2) as m,
  regexp_extract(duration_text, '^(\\d+)h:(\\d+)m:(\\d+)s$', 3) as s,
  case when trim(lead_raw) = 'true' or trim(lead_raw) like '%.5' then null else regexp_replace(trim(lead_raw), '\\.0$', '') end as lead from raw),
timed as (select *, case when try_cast(m as int) < 60 and try_cast(s as int) < 60
    then try_cast(h as bigint) * 3600 + try_cast(m as bigint) * 60 + try_cast(s as bigint) end as seconds,
  try_cast(created_on as timestamp) as created_at from parts),
ruled as (select *,
  case when is_formula then 'Formula in source record; requires review'
       when lead_raw is null or lead_raw = 'true' then 'Missing or invalid Lead Number'
       when lead is null then 'Fractional Lead Number'
       when proto <> 'https' or not regexp_matches(auth, '^(.*@)?{HOST}(:\\d+)?$') then 'Recording URL outside the approved HTTPS source host'
       when not regexp_matches(auth, '^{HOST}(:443)?$') then 'Unexpected recording URL credentials or port' end as early,
  case when created_at is null then 'CreatedOn is not a date' when seconds is null then 'Invalid call duration'
       when seconds <= 0 then 'Non-positive duration' when flag not in ('', 'Yes', 'No') then 'Unrecognised conversion flag' end as late
  from timed),
validated as (select *, case when early is not null then early
  when exists (select 1 from ruled e where e.url = r.url and e.source_row < r.source_row and e.early is null and e.late is null)
    then 'Duplicate recording URL' else late end as reason from ruled r)"""

OUTCOMES = """outcomes as (select lead, count(*) as calls, bool_and(coalesce(flag, '') = 'Yes') as all_yes,
  bool_or(coalesce(flag, '') = 'Yes') as any_yes from calls group by lead)"""
PRE_SQL = """pre as (select * from (select *, sum(case when conversation_type in ('enrollment_or_payment', 'learner_support', 'administrative')
    then 1 else 0 end) over (partition by lead order by created_on, call_id rows unbounded preceding) as posts from calls)
  where posts = 0 and conversation_type in ('sales', 'brief_followup'))"""
LIVE_SQL = """live as (select c.lead, max(case when conversation_type <> 'unusable' then created_on end) as live_at,
    arg_max(case when conversation_type <> 'unusable' then call_id end,
            case when conversation_type <> 'unusable' then strftime(created_on, '%Y%m%d%H%M%S') || call_id end) as live_call_id
  from calls c group by c.lead),
last_live as (select l.lead, l.live_call_id, l.live_at, (select count(*) from calls c where c.lead = l.lead and (l.live_at is null
    or c.created_on > l.live_at or (c.created_on = l.live_at and c.call_id > l.live_call_id))) as attempts_since from live l)"""
LABEL = """case when all_yes then 'CRM reported converted; unverified' when any_yes then 'Mixed CRM flags; unresolved'
  else 'Outcome unknown' end"""


def accepted(t):
    return ingest.split(ingest.validate(t.raw_calls, HOST))


@query("call_quarantine", f"with {ctes('raw_calls')}, {VALIDATED} select source_row, coalesce(reason, 'accepted') as status, lead, seconds from validated")
def call_quarantine(t):
    rows = ingest.validate(t.raw_calls, HOST)
    return rows.select("source_row", F.coalesce("reason", F.lit("accepted")).alias("status"), "lead", "seconds")


@query("call_keys", f"""with {ctes('raw_calls')}, {VALIDATED} select source_row, 'C' || left(sha256('"' || url || '"'), 16) as call_id
  from validated where reason is null""")
def call_keys(t):
    return accepted(t)[0].select("source_row", "call_id")


@query("import_audit", f"""with {ctes('calls')}, {OUTCOMES}
 select 'calls' as metric, '' as key, cast(count(*) as double) as value from calls
 union all select 'leads', '', cast(count(distinct lead) as double) from calls
 union all select 'audio_minutes', '', round(sum(duration_seconds) / 60.0, 6) from calls
 union all select 'lead_outcomes', {LABEL}, cast(count(*) as double) from outcomes group by 2
 union all select 'status', status, cast(count(*) as double) from calls group by 2
 union all select 'calls_per_lead', cast(calls as varchar), cast(count(*) as double) from outcomes group by 2
 union all select 'first_call', cast(min(created_on) as varchar), 0.0 from calls
 union all select 'last_call', cast(max(created_on) as varchar), 0.0 from calls""")
def import_audit(t):
    return rounded(ingest.import_audit(t.calls))


@query("dataset_digest", f"""with {ctes('calls')}, h as (select sha256('["' || call_id || '", "' || created_on || '", "' || lead || '"]') as h from calls)
 select count(*) as rows, sha256(concat_ws('-', count(*), {', '.join(
     f"sum(('0x' || substr(h, {1 + 12 * i}, 12))::bigint)::hugeint" for i in range(5))})) as sha256 from h""")
def dataset_digest_query(t):
    return dataset_digest(t.calls.select("lead", "call_id", "created_on"))


@query("hash_sample", f"""with {ctes('leads')} select lead, sha256('["{SEED}", "' || lead || '"]') as draw_hash from leads
  order by draw_hash limit 31""")
def hash_sample(t):
    return sampling.draw(t.leads, SEED, 31)


@query("lead_aliases", f"""with {ctes('leads')} select lead, 'L' || case when n < 1000 then lpad(cast(n as varchar), 3, '0') else cast(n as varchar) end
  as lead_alias from (select lead, row_number() over (order by sha256('["{SEED}", "' || lead || '"]')) as n from leads)""")
def lead_aliases(t):
    return sampling.with_aliases(t.leads.select("lead"), "L", SEED)


STRATA = f"quotas(calls, quota) as (values {QUOTA_ROWS})"
DRAWN = f"""drawn as (select o.*, quota, sha256('["{SEED}", "' || lead || '"]') as draw_hash from outcomes o join quotas using (calls))"""


@query("stratified_sample", f"""with {ctes('calls')}, {OUTCOMES}, {STRATA}, {DRAWN}
 select lead, calls, draw_rank from (select *, row_number() over (partition by calls order by draw_hash) as draw_rank from drawn)
 where draw_rank <= quota""")
def stratified_sample(t):
    return sampling.stratified(journeys.outcomes(t.calls), SEED, DEFAULT_QUOTAS, strict=False).select("lead", "calls", F.col("draw_rank").cast("bigint").alias("draw_rank"))


BALANCED = f"""loads as (select salesperson, count(*) as load from calls group by 1),
 agent as (select lead, avg(load) as agent_load from (select distinct lead, salesperson from calls) join loads using (salesperson) group by lead),
 turns as (select d.*, {LABEL} as outcome, row_number() over (partition by calls, {LABEL} order by agent_load, draw_hash) as turn
   from drawn d join agent using (lead)),
 picked as (select * from (select *, row_number() over (partition by calls order by turn, outcome, draw_hash) as draw_rank from turns)
   where draw_rank <= quota)"""


def pilot(t):
    """The outcome-balanced sample of whole journeys, as leads."""
    leads = journeys.outcomes(t.calls).join(sampling.agent_load(t.calls), "lead")
    return sampling.balanced(leads, SEED, DEFAULT_QUOTAS, strict=False)  # small given tables may be short


@query("balanced_sample", f"with {ctes('calls')}, {OUTCOMES}, {STRATA}, {DRAWN}, {BALANCED} select lead, calls, outcome, draw_rank from picked")
def balanced_sample(t):
    return pilot(t).select("lead", "calls", "outcome", F.col("draw_rank").cast("bigint").alias("draw_rank"))


HOLDOUT = f"""ordered as (select *, row_number() over (order by calls, sha256('["{SEED}", "qa", "' || lead || '"]')) as holdout_rank from outcomes),
 split as (select *, case when holdout_rank % 5 = 0 then 'holdout' else 'development' end as split from ordered)"""


@query("holdout_split", f"with {ctes('calls')}, {OUTCOMES}, {HOLDOUT} select lead, calls, holdout_rank, split from split")
def holdout_split(t):
    """Over every lead: the rank is exact without a global window."""
    return sampling.holdout(journeys.outcomes(t.calls), SEED).select("lead", "calls", "holdout_rank", "split")


SELECTED = f"""{STRATA}, {DRAWN}, {BALANCED}, chosen as (select lead, row_number() over (order by calls, sha256('["{SEED}", "qa", "' || lead || '"]')) as r,
   row_number() over (order by sha256('["{SEED}", "' || lead || '"]')) as a from picked),
 selected as (select c.*, case when r % 5 = 0 then 'holdout' else 'development' end as split, 'L' || lpad(cast(a as varchar), 3, '0') as lead_alias,
   row_number() over (partition by lead order by created_on, call_id) as call_number from calls c join chosen using (lead))"""


def selection(t):
    """Calls of the pilot leads with alias, split and number."""
    leads = sampling.with_aliases(sampling.holdout(pilot(t), SEED), "L", SEED).select("lead", "lead_alias", "split")
    return journeys.number_calls(t.calls.join(leads, "lead"))


@query("selected_calls", f"""with {ctes('calls')}, {OUTCOMES}, {SELECTED}
 select call_id, lead, lead_alias, call_number, split from selected where split = 'development'""")
def selected_calls(t):
    return sampling.select_calls(selection(t), "development").select("call_id", "lead", "lead_alias", "call_number", "split")


@query("selection_summary", f"""with {ctes('calls')}, {OUTCOMES}, {SELECTED} select count(*) as calls, count(distinct lead) as leads,
 round(sum(duration_seconds) / 60.0, 6) as audio_minutes, count(*) filter (split = 'holdout') as holdout_calls,
 count(distinct case when split = 'holdout' then lead end) as holdout_leads, count(distinct salesperson) as salespeople from selected""")
def selection_summary(t):
    return rounded(sampling.selection_summary(selection(t)))


PILOT_SQL = f"{STRATA}, {DRAWN}, {BALANCED}"
COHORT_ROWS = """select call_id, lead, '{p}' || case when n < {lim} then lpad(cast(n as varchar), {w}, '0') else cast(n as varchar) end as lead_alias,
 row_number() over (partition by lead order by created_on, call_id) as call_number, count(*) over (partition by lead) as journey_calls
 from calls join (select lead, row_number() over (order by sha256('["{name}", "' || lead || '"]')) as n from grp) using (lead)"""


def cohort_rows(name, prefix, width=3):
    return COHORT_ROWS.format(p=prefix, w=width, lim=10 ** width, name=name)


COLUMNS = ("call_id", "lead", "lead_alias", "call_number", "journey_calls")


@query("cohort_customers", f"""with {ctes('calls')}, {OUTCOMES}, {PILOT_SQL},
 grp as (select lead from outcomes where all_yes and lead not in (select lead from picked)) {cohort_rows('customers', 'K')}""")
def cohort_customers(t):
    return sampling.cohort_calls(t.calls, sampling.customers(t.calls, pilot(t)), "customers", "K").select(*COLUMNS)


def open_sample(t):
    pool = sampling.open_pool(t.calls, pilot(t))
    return pool.join(sampling.draw(pool, "open_sample", sampling.OPEN_SAMPLE_SIZE), "lead", "left_semi")


OPEN_SQL = """pool as (select lead from outcomes where not any_yes and lead not in (select lead from picked)
   and lead in (select lead from calls group by lead having max(duration_seconds) >= 180)),
 open_grp as (select lead from pool order by sha256('["open_sample", "' || lead || '"]') limit 150)"""


@query("cohort_open_sample", f"""with {ctes('calls')}, {OUTCOMES}, {PILOT_SQL}, {OPEN_SQL}, grp as (select lead from open_grp)
 {cohort_rows('open_sample', 'N')}""")
def cohort_open_sample(t):
    return sampling.cohort_calls(t.calls, open_sample(t), "open_sample", "N").select(*COLUMNS)


@query("cohort_archive", f"""with {ctes('calls')}, {OUTCOMES}, {PILOT_SQL}, {OPEN_SQL}, grp as (select lead from outcomes
   where lead not in (select lead from picked) and lead not in (select lead from open_grp) and not all_yes) {cohort_rows('archive', 'A', 5)}""")
def cohort_archive(t):
    leads = sampling.archive(t.calls, pilot(t), sampling.customers(t.calls, pilot(t)), open_sample(t))
    return sampling.cohort_calls(t.calls, leads, "archive", "A", 5).select(*COLUMNS)


@query("worklist_leads", f"""with {ctes('calls')}, {OUTCOMES}, {PILOT_SQL}, {OPEN_SQL}
 select lead, 'pilot' as source from outcomes where not any_yes and lead in (select lead from picked)
 union all select lead, 'non-buyer sample' from (select lead from open_grp order by sha256('["{SEED}", "' || lead || '"]') limit 31)""")
def worklist_leads(t):
    """Open pilot leads and a seeded draw from the non-buyer sample."""
    open_pilot = journeys.outcomes(t.calls).filter(~F.col("any_yes")).join(pilot(t).select("lead"), "lead", "left_semi")
    drawn = sampling.draw(open_sample(t), SEED, 31)
    return open_pilot.select("lead", F.lit("pilot").alias("source")).unionByName(drawn.select("lead", F.lit("non-buyer sample").alias("source")))


@query("group_fallback", f"""with {ctes('calls')}, {OUTCOMES}, {PILOT_SQL}, {OPEN_SQL}, cust as (select lead from outcomes where all_yes)
 select lead, call_id, case when lead in (select lead from picked) then 'pilot' when lead in (select lead from open_grp) then 'open_sample'
   else 'customers' end as source_group from calls where lead in (select lead from picked union select lead from open_grp union select lead from cust)""")
def group_fallback(t):
    calls = t.calls
    take = lambda leads: calls.join(leads.select("lead"), "lead", "left_semi")
    groups = [("pilot", take(pilot(t))), ("open_sample", take(open_sample(t))), ("customers", take(journeys.outcomes(calls).filter("all_yes")))]
    return journeys.first_group(groups).select("lead", "call_id", "source_group")


@query("journey_numbers", f"""with {ctes('calls')} select call_id, lead, row_number() over (partition by lead order by created_on, call_id)
 as call_number, count(*) over (partition by lead) as journey_calls from calls""")
def journey_numbers(t):
    return journeys.number_calls(t.calls).select("call_id", "lead", "call_number", "journey_calls")


@query("lead_outcomes", f"with {ctes('calls')}, {OUTCOMES} select lead, calls, all_yes, any_yes, {LABEL} as outcome from outcomes")
def lead_outcomes(t):
    return journeys.outcomes(t.calls).select("lead", "calls", "all_yes", "any_yes", "outcome")


@query("eligible_leads", f"""with {ctes('calls')} select lead, max(duration_seconds) as longest_seconds from calls group by lead
 having max(duration_seconds) >= 180""")
def eligible_leads(t):
    return journeys.eligible(t.calls)


@query("pre_purchase_calls", f"with {ctes('calls')}, {PRE_SQL} select call_id, lead, created_on from pre")
def pre_purchase_calls(t):
    return journeys.pre_purchase(t.calls).select("call_id", "lead", "created_on")


@query("last_live_calls", f"with {ctes('calls')}, {LIVE_SQL} select * from last_live")
def last_live_calls(t):
    return journeys.last_live(t.calls)


@query("journey_rollup", f"""with {ctes('calls')}, g as (select *, epoch(created_on - lag(created_on) over (partition by lead order by created_on, call_id)) / 86400
   as gap from calls) select lead, count(*) as calls, round(sum(duration_seconds) / 60.0, 6) as minutes, min(created_on) as first_call,
   max(created_on) as last_call, max(duration_seconds) as longest_seconds, count(distinct salesperson) as salespeople,
   arg_max(salesperson, strftime(created_on, '%Y%m%d%H%M%S') || call_id) as last_salesperson, round(avg(gap), 6) as mean_gap_days
 from g group by lead""")
def journey_rollup(t):
    return rounded(journeys.rollup(t.calls))


BUYER_LAGS = f"""{PRE_SQL}, posts as (select lead, min(created_on) as post_at from calls
   where conversation_type in ('enrollment_or_payment', 'learner_support', 'administrative') group by lead),
 lags as (select date_diff('day', max(pre.created_on), post_at) as lag_days from pre join posts using (lead) group by lead, post_at)"""


@query("buyer_timing", f"""with {ctes('calls')}, {BUYER_LAGS}, s as (select list_sort(list(lag_days)) as v from lags)
 select cast(len(v) as bigint) as customers, cast(v[cast(floor(len(v) / 2) as int) + 1] as int) as median_days,
  round(len(list_filter(v, lambda x: x <= 45)) / len(v), 6) as within_45_share,
  round(len(list_filter(v, lambda x: x <= 90)) / len(v), 6) as within_90_share from s""")
def buyer_timing(t):
    return rounded(journeys.buyer_timing(t.calls))


@query("export_date", f"with {ctes('calls')} select cast(max(created_on)::date as varchar) as as_of from calls")
def export_date(t):
    return t.calls.agg(F.to_date(F.max("created_on")).cast("string").alias("as_of"))


@query("url_digests", """select page_id, 'C' || left(sha256('"' || url || '"'), 16) as page_key, sha256('["pages", "' || url || '", 7]') as digest from pages""")
def url_digests(t):
    return t.raw("pages").select("page_id", call_key(F.col("url")).alias("page_key"), digest("pages", F.col("url"), 7).alias("digest"))
