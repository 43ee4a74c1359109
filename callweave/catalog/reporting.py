"""Report tables, labels and cost figures."""

from pyspark.sql import functions as F

from ..operators.small import constants
from ..plans import reporting as rp
from ..sources.bindings import FACT_FIELDS, ctes
from .base import query, rounded
from .journeys import OUTCOMES

BASE = ctes("calls", "items", "extractions")
KEY = "strftime(created_on, '%Y%m%d%H%M%S')"


@query("call_table", f"""with {ctes('calls', 'extractions')} select c.call_id, lead, conversation_type, summary, next_action,
 case when e.call_id is null then 'Pending or failed extraction' else 'Evidence checked; semantic QA pending' end as processing_status
 from calls c left join (select * from extractions where analysed) e on e.call_id = c.call_id""")
def call_table(t):
    return rp.call_table(t.calls, t.extractions).select("call_id", "lead", "conversation_type", "summary", "next_action", "processing_status")


@query("analysed_calls", f"with {ctes('calls', 'extractions')} select c.call_id, lead, summary, next_action from calls c join extractions e on e.call_id = c.call_id where analysed")
def analysed_calls(t):
    return rp.analysed(t.calls, t.extractions).select("call_id", "lead", "summary", "next_action")


@query("objection_summary", f"""with {ctes('items')} select label as category, count(*) as instances, count(distinct call_id) as calls,
 {', '.join(f"count(*) filter (resolution = '{r}') as {r}" for r in rp.RESOLUTIONS)} from items where collection = 'objections' group by label""")
def objection_summary(t):
    return rp.objection_summary(t.items)


@query("signal_summary", f"with {ctes('items')} select label as kind, count(distinct call_id) as calls from items where collection = 'signals' group by label")
def signal_summary(t):
    return rp.signal_summary(t.items)


@query("summary_examples", f"""with {ctes('calls', 'items')}, o as (select call_id, label, item_pos, text, 'objection' as kind from items where collection = 'objections'
  union all select call_id, label, item_pos, text, 'signal' from items where collection = 'signals' qualify row_number() over (partition by call_id, label order by item_pos, text) = 1)
 select o.kind, o.label, o.call_id, o.text, row_number() over (partition by kind, label order by lead, created_on, o.call_id, item_pos)::int as example from o join calls c on c.call_id = o.call_id
 qualify example <= 3""")
def summary_examples(t):
    return rp.examples(t.items, t.calls).select("kind", "label", "call_id", "text", "example")


@query("top_values", f"""with {ctes('calls', 'items')} select lower(trim(text)) as value, count(distinct i.call_id) as calls from items i join calls c on c.call_id = i.call_id
 where collection = 'facts' and label = 'current_role' and conversation_type in ('sales', 'enrollment_or_payment') group by 1 order by calls desc, value limit 8""")
def top_values(t):
    return rp.top_values(t.items, t.calls, "current_role")


_in = lambda v: "(" + ", ".join(f"'{x}'" for x in v) + ")"
QFLAGS = f"""q as (select call_id, bool_or(collection = 'facts' and label in {_in(rp.QUALIFICATION)}) as qualification, bool_or(collection = 'facts' and label in {_in(rp.DISCOVERY)}) as discovery,
  bool_or(collection = 'pitches') as pitch, bool_or(collection = 'objections' and response is not null) as objection_handling,
  bool_or(collection = 'signals' and label in {_in(rp.CLOSING)}) as closing, bool_or(collection = 'objections') as has_objections from items group by call_id),
 s as (select c.call_id, q.* exclude (call_id) from calls c left join q on q.call_id = c.call_id where conversation_type in ('sales', 'enrollment_or_payment'))"""


@query("quality_coverage", f"with {ctes('calls', 'items')}, {QFLAGS} " + " union all ".join(
    f"select '{d}' as dimension, count(*) filter ({d}) as calls_with_evidence, {'count(*) filter (has_objections)' if d == 'objection_handling' else 'count(*)'} as applicable_calls from s"
    for d in ("qualification", "discovery", "pitch", "objection_handling", "closing")))
def quality_coverage(t):
    return rp.quality_coverage(t.items, t.calls)


@query("latest_profile_conflicts", f"""with {ctes('calls', 'items')} select lead, label as field, arg_max(text, {KEY} || c.call_id || ' ' || item_pos) as value,
 count(distinct text) > 1 as conflicting from items i join calls c on c.call_id = i.call_id where collection = 'facts' group by 1, 2""")
def latest_profile_conflicts(t):
    return rp.latest_values(t.items, t.calls)


@query("lead_profiles", f"""with {ctes('calls', 'items')}, v as (select lead, label as field, arg_max(text, {KEY} || c.call_id || ' ' || item_pos) as value,
 count(distinct text) > 1 as conflicting from items i join calls c on c.call_id = i.call_id where collection = 'facts' group by 1, 2)
 select lead, {', '.join(f"max(value) filter (field = '{f}') as {f}" for f in FACT_FIELDS)}, coalesce(string_agg(field, '; ' order by field) filter (conflicting), '') as conflicting_fields
 from v group by lead""")
def lead_profiles(t):
    return rp.profile_table(t.items, t.calls, FACT_FIELDS)


_sig = lambda *k: f"coalesce(bool_or(collection = 'signals' and label in {_in(k)}), false)"
STATE = f"""{OUTCOMES}, sf as (select call_id, {_sig('do_not_contact')} as dnc, {_sig('payment_intent')} as payment_intent, {_sig('urgency')} as urgency, {_sig('demo_requested')} as demo,
  {_sig('followup_agreed')} as followup, {_sig('low_interest', 'not_a_fit')} as cold, {_sig('followup_agreed', 'demo_requested', 'price_question', 'goal')} as warm,
  {_sig('payment_intent', 'payment_claim')} as pay from items group by call_id),
 c1 as (select c.*, coalesce(e.analysed, false) as done, e.next_action, coalesce(dnc, false) as dnc, coalesce(payment_intent, false) as payment_intent, coalesce(urgency, false) as urgency,
   coalesce(demo, false) as demo, coalesce(followup, false) as followup, coalesce(cold, false) as cold, coalesce(warm, false) as warm, coalesce(pay, false) as pay,
   row_number() over (partition by lead order by created_on, c.call_id) as rn from calls c left join extractions e on e.call_id = c.call_id left join sf on sf.call_id = c.call_id),
 lv as (select * from c1 where done and conversation_type <> 'unusable' qualify row_number() over (partition by lead order by rn desc) = 1),
 st as (select g.*, o.any_yes, lv.conversation_type as live_type, lv.next_action as live_action, lv.rn as live_rn, lv.payment_intent as p_, lv.urgency as u_, lv.demo as d_, lv.followup as f_, lv.cold as c_, lv.warm as w_
   from (select lead, count(*) as calls, count(*) filter (done) as calls_analysed, bool_or(done and dnc) as any_dnc, bool_or(done and pay) as any_pay, sum(duration_seconds) as seconds from c1 group by lead) g
   join outcomes o on o.lead = g.lead left join lv on lv.lead = g.lead),
 pr as (select *, case when live_rn is null then 0 else calls - live_rn end as unanswered,
   case when any_dnc then 'Do not contact' when any_yes then 'Verify enrollment' when calls <> calls_analysed then 'Needs review' when live_rn is null then 'No live conversation'
    when live_type in ('learner_support', 'administrative') then 'Service follow-up' when p_ or (u_ and (d_ or f_)) then 'Hot signal' when c_ then 'Cold signal'
    when w_ then 'Warm signal' else 'Unclassified' end as priority from st)"""
REASONS = {"Do not contact": "A recorded request to stop contact needs to be respected.",
           "Verify enrollment": "CRM contains a Yes flag; confirm enrollment before further sales follow-up.",
           "Needs review": "The selected journey has calls without validated extraction.",
           "No live conversation": "Every recorded call reached voicemail or had no usable conversation.",
           "Service follow-up": "The last live conversation concerns learner support or administration.",
           "Hot signal": "The last live conversation contains an explicit purchase or urgent next-step signal.",
           "Cold signal": "The last live conversation contains an explicit lack of interest or fit.",
           "Warm signal": "The last live conversation contains a goal, product question or agreed next step.",
           "Unclassified": "The last live conversation does not support a clear buying-temperature label."}
REASON = "case priority " + " ".join(f"when '{k}' then '{v}'" for k, v in REASONS.items()) + " end"


@query("priority_labels", f"with {BASE}, {STATE} select lead, priority, {REASON} as priority_reason, calls, calls_analysed, unanswered from pr")
def priority_labels(t):
    return rp.journey_state(t.calls, t.extractions, t.items).select("lead", "priority", "priority_reason", "calls", "calls_analysed", "unanswered")


OPEN = f"""op as (select c.lead, c.created_on, i.call_id, i.item_pos, i.label, i.text from items i join calls c on c.call_id = i.call_id join extractions e on e.call_id = i.call_id
   where collection = 'objections' and resolution <> 'resolved' and analysed)"""


@query("lead_report", f"""with {BASE}, {STATE}, {OPEN}, oc as (select lead, count(*) as n from op group by lead),
 kn as (select lead, bool_or(label = 'goal') as g, bool_or(label = 'timeline') as tl, bool_or(label = 'budget') as b from items i join calls c on c.call_id = i.call_id
   join extractions e on e.call_id = i.call_id where collection = 'facts' and analysed group by lead),
 sg as (select lead, text, min({KEY} || c.call_id || ' ' || item_pos) as first_at from items i join calls c on c.call_id = i.call_id join extractions e on e.call_id = i.call_id
   where analysed and collection = 'signals' and label in ('goal', 'urgency', 'payment_intent') group by 1, 2),
 ss as (select lead, left(string_agg(text, '; ' order by first_at), 1200) as strengths from sg group by lead),
 r as (select pr.*, coalesce(n, 0) as open_count, calls = calls_analysed as complete, coalesce(strengths, '') as strengths,
   concat_ws('; ', case when not coalesce(g, false) then 'goal' end, case when not coalesce(tl, false) then 'timeline' end, case when not coalesce(b, false) then 'budget' end) as unk,
   case when calls <> calls_analysed then 'Finish reviewing the available calls.' when live_rn is null
     then 'No call reached the lead. Confirm the phone number and try another channel such as WhatsApp or email before further calls.'
     else case when unanswered > 0 then 'The last ' || unanswered || ' call(s) reached voicemail or no conversation. From the last live conversation: ' else '' end || live_action end as act
  from pr left join oc on oc.lead = pr.lead left join kn on kn.lead = pr.lead left join ss on ss.lead = pr.lead)
 select lead, priority, {REASON} as priority_reason, calls, calls_analysed, unanswered, open_count,
  case priority when 'Verify enrollment' then 'Confirm enrollment/payment and current lead status before any further sales outreach. ' || act
   when 'Do not contact' then 'Respect the request to stop contact; confirm the CRM suppression setting.' else act end as next_action_suggestion,
  case when not complete then 'Not assessed: journey extraction incomplete' when seconds >= 1800 and open_count >= 2 and not any_pay then 'Review effort' else 'No rule triggered' end as effort_review,
  case when not complete then 'Analysis incomplete' when unk = '' then 'No missing key discovery fields detected' else unk end as weaknesses_or_unknowns,
  case when not complete then 'Complete the journey review' when open_count > 0 then 'Address the documented concern and agree a specific next step'
   else 'Confirm current need and readiness before proposing a next step' end as opportunity, strengths from r""")
def lead_report(t):
    return rp.lead_report(t.calls, t.extractions, t.items)


@query("objection_texts", f"""with {BASE}, {OPEN}, n as (select *, row_number() over (partition by lead order by created_on, call_id, item_pos) as rn from op)
 select lead, cast(floor((rn - 1) / 200) + 1 as bigint) as part, string_agg(label || ': ' || text || ' (' || call_id || ')', '; ' order by rn) as open_objections,
  string_agg(label, '; ' order by rn) as threats from n group by 1, 2""")
def objection_texts(t):
    return rp.objection_texts(t.calls, t.extractions, t.items)


@query("evidence_table", f"""with {ctes('calls', 'items', 'lines')}, long as (
  select call_id, collection, item_pos, label, 'evidence' as evidence_type, segment_id as cited_id, text as claim from items
  union all select call_id, collection, item_pos, label, 'response_evidence', response_segment_id, response from items where response_segment_id is not null
  union all select call_id, collection, item_pos, label, 'resolution_evidence', resolution_segment_id, resolution || ': ' || text from items where resolution_segment_id is not null)
 select l.*, c.lead, cast(s.start as double) as start, cast(s.end_at as double) as end_at from long l join lines s on s.call_id = l.call_id and s.segment_id = l.cited_id join calls c on c.call_id = l.call_id""")
def evidence_table(t):
    rows = rp.evidence_table(t.items, t.calls, t.lines)
    return rows.withColumns({"start": F.col("start").cast("double"), "end_at": F.col("end_at").cast("double")})


@query("export_overview", f"""with {BASE} select (select count(*) from calls) as selected_calls, (select count(distinct lead) from calls) as selected_leads,
 (select count(*) from extractions where analysed) as analysed_calls,
 (select count(*) from (select lead from calls c left join extractions e on e.call_id = c.call_id group by lead having bool_and(analysed))) as complete_extracted_journeys,
 (select count(*) from (select distinct i.call_id, label from items i join extractions e on e.call_id = i.call_id where collection = 'objections' and analysed)) as objection_mentions_by_call""")
def export_overview(t):
    return rp.overview(t.calls, t.extractions, t.items)


@query("cost_summary", f"""with {ctes('calls', 'ledger', 'budget_events')}, m as (select l.*, exists (select 1 from calls c where c.call_id = l.call_id) as ours from ledger l),
 s as (select sum(case when ours then external_cost_inr else 0 end) + sum(case when stage = 'remote_usage' then external_cost_inr else 0 end) as spend,
   sum(case when ours and stage in ('transcribe', 'extract', 'resolve', 'verify') then wall_seconds end) / 3600 as wh,
   count(*) filter (ours and stage in ('transcribe', 'extract', 'resolve', 'verify') and status = 'failed') as failed from m),
 a as (select coalesce(sum(duration_seconds), 0) / 60.0 as minutes from calls where call_id in (select call_id from ledger where stage = 'transcribe' and status = 'success')),
 z as (select sum(duration_seconds) / 60.0 as archive from calls), b as (select sum(final_inr) as committed from budget_events)
 select round(spend, 4) as external_api_spend_inr, round(wh, 4) as wall_hours, failed as failed_attempts, round(minutes, 4) as unique_transcribed_audio_minutes,
  round(committed - spend, 4) as unreconciled_reserve_inr, round(spend / minutes, 4) as external_api_inr_per_audio_minute, round(spend + wh * 12.5, 4) as processing_cost_inr,
  round((spend + wh * 12.5) / minutes, 4) as processing_inr_per_audio_minute, round_even(archive - minutes, 0) as phase_remaining_audio_minutes,
  round(case when archive - minutes > 0 then 35000 / (archive - minutes) end, 4) as phase_allowed_inr_per_audio_minute from s, a, z, b""")
def cost_summary(t):
    committed = t.budget_events.agg(F.sum("final_inr").alias("committed_inr"))
    return rounded(rp.cost_summary(t.ledger, t.calls, committed, 12.5), 4)


RUN_DAYS = ("2024-01-05", "2024-01-06")


@query("method_cost", f"""with {ctes('ledger')}, f as (select *, stage = 'transcribe' and system = 'labelled-v1' and status = 'success' as ours from ledger),
 x as (select sum(audio_seconds) filter (ours) / 60 as minutes, sum(external_cost_inr) filter (ours) as tr,
  sum(external_cost_inr) filter (not ours and recorded_at::date in ('2024-01-05', '2024-01-06') and stage not in ('transcribe', 'experiment', 'qa')) as other from f)
 select round(minutes, 6) as minutes, round(tr / minutes, 6) as transcription_per_min, round((tr + other) / minutes, 6) as all_in_upper_per_min from x""")
def method_cost(t):
    return rounded(rp.method_cost(t.ledger, "labelled-v1", RUN_DAYS))


@query("usage_cost", f"""with {ctes('ledger')} select event_id, round((input_tokens * r.i + output_tokens * r.o) / 1e6 * 125.0, 8) as cost_inr
 from ledger l left join (values ('labelled-v1', 1.5, 9.0), ('local-v1', 0.0, 0.0)) r(s, i, o) on r.s = l.system""")
def usage_cost(t):
    rates = constants(t.spark, [("labelled-v1", 1.5, 9.0), ("local-v1", 0.0, 0.0)], "system string, rate_in double, rate_out double")
    return rounded(rp.usage_cost(t.ledger, rates).select("event_id", "cost_inr"), 8)
