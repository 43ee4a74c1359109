"""The given tables seen as leads, calls, claims, segments, ledger and reviews.

Each binding is one projection (at most one equi-join) in SQL both Spark and DuckDB read, so a check starts from the same
rows and compares the operators. Nothing is filtered out: a binding's size grows with its table.
"""

from ..session import widen

# ---- fixed values: enumerations of the claim schema, in their order ----
FACT_FIELDS = ("location", "current_role", "company", "experience", "current_ctc", "target_role", "technology_interest",
               "course", "goal", "timeline", "budget", "availability")
SIGNAL_KINDS = ("goal", "urgency", "price_question", "payment_intent", "payment_claim", "followup_agreed",
                "demo_requested", "low_interest", "no_time", "not_a_fit", "do_not_contact", "other")
OBJECTION_CATEGORIES = ("price", "time", "trust", "course_fit", "prerequisites", "career_outcomes", "format", "timing",
                        "decision_maker", "other")
STANCES = ("commitment", "conditional_commitment", "dated_deferral", "open_deferral", "open", "declined",
           "product_not_sold", "none", "recording_unusable")
ROLE_GROUPS = ("software_developer", "testing_qa", "data_analytics_bi", "data_engineering", "data_science_ml",
               "cloud_devops", "database_admin", "it_support_operations", "other_it", "non_it", "student", "unknown")
MOTIVATIONS = ("switch_into_data_field", "grow_in_current_data_role", "better_salary_or_job", "find_a_job",
               "skills_for_current_project", "buying_for_team", "other", "unknown")
# ---- end of fixed values ----


def pick(expression, values):
    """CASE index -> value, portable between engines."""
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {expression} {whens} end"


_LABEL = (f"case l_linenumber % 4 when 0 then {pick(f'l_partkey % {len(FACT_FIELDS)}', FACT_FIELDS)} "
          f"when 1 then {pick(f'l_partkey % {len(SIGNAL_KINDS)}', SIGNAL_KINDS)} "
          f"when 2 then {pick(f'l_partkey % {len(OBJECTION_CATEGORIES)}', OBJECTION_CATEGORIES)} else 'pitch' end")
_POS = ("cast(l_linenumber as string) || '-' || lpad(cast(l_partkey as string), 10, '0') || '-' || "
        "lpad(cast(l_suppkey as string), 9, '0') || '-' || lpad(cast(cast(l_quantity as bigint) as string), 4, '0') || '-' || "
        "lpad(cast(cast(round(l_extendedprice * 100, 0) as bigint) as string), 12, '0')")


SQL = {
    "calls": """
      select 'C' || cast(o_orderkey as string) as call_id, cast(o_custkey as string) as lead, o_orderkey as source_row,
        o_orderdate as created_on, cast(floor(o_totalprice / 400) as int) as duration_seconds,
        case when o_orderpriority = '1-URGENT' then
               case when o_orderkey % 5 < 3 then 'enrollment_or_payment' when o_orderkey % 5 = 3 then 'learner_support'
                    else 'administrative' end
             when o_orderpriority = '4-NOT SPECIFIED' then 'unusable' when o_orderpriority = '5-LOW' then 'brief_followup'
             else 'sales' end as conversation_type,
        case when o_custkey % 10 < 3 then 'Yes' when o_custkey % 10 = 3 and o_orderstatus = 'F' then 'Yes'
             when o_orderstatus = 'O' then 'No' end as flag,
        'Agent ' || cast(o_orderkey % 97 as string) as salesperson, o_orderstatus as status,
        o_totalprice as price
      from {orders}""",
    "leads": """
      select cast(c_custkey as string) as lead, c_name as lead_name, n_name as nation, c_mktsegment as segment, c_acctbal as balance
      from {customer} join {nation} on c_nationkey = n_nationkey""",
    "profiles": f"""
      select cast(c_custkey as string) as lead,
        case when c_acctbal < 0 then null else cast(floor(c_acctbal / 700) as double) end as experience_years,
        case when c_custkey % 11 = 0 then 'yes' else 'no' end as fresher,
        case c_mktsegment when 'MACHINERY' then 'non_it' when 'HOUSEHOLD' then 'unknown' else 'it' end as background,
        case when c_custkey % 7 = 0 then 'over_1_year' when c_custkey % 7 < 3 then 'up_to_1_year' else 'not_mentioned' end as career_gap,
        case when c_custkey % 5 = 0 then 'not_working' when c_custkey % 5 = 1 then 'student' when c_custkey % 5 = 2 then 'unknown'
             else 'employed' end as employment,
        {pick(f'c_custkey % {len(ROLE_GROUPS)}', ROLE_GROUPS)} as current_role_group,
        case when n_regionkey = 2 then 'india' else 'abroad' end as location_group,
        {pick(f'c_custkey % {len(MOTIVATIONS)}', MOTIVATIONS)} as motivation
      from {{customer}} join {{nation}} on c_nationkey = n_nationkey""",
    # A profile value's cited call: one of the five profile fields, cited from one of the lead's calls.
    "profile_refs": """
      select cast(o_custkey as string) as lead, case o_orderkey % 5 when 0 then 'background' when 1 then 'fresher'
        when 2 then 'career_gap' when 3 then 'employment' else 'current_role_group' end as field,
        'C' || cast(o_orderkey as string) as call_id, o_orderkey % 4 as segment_id
      from {orders}""",
    "items": f"""
      select 'C' || cast(l_orderkey as string) as call_id,
        case l_linenumber % 4 when 0 then 'facts' when 1 then 'signals' when 2 then 'objections' else 'pitches' end as collection,
        {_POS} as item_pos, {_LABEL} as label,
        case l_linenumber % 4 when 0 then 'value ' || cast(l_suppkey % 9 as string) when 1 then 'said ' || cast(l_suppkey % 13 as string)
          when 2 then 'concern ' || cast(l_suppkey % 11 as string) else 'topic ' || cast(l_partkey % 7 as string) end as text,
        case when l_linenumber % 4 >= 2 and l_quantity > 25 then 'response ' || cast(l_suppkey % 5 as string) end as response,
        case when l_linenumber % 4 = 2 then case l_returnflag when 'R' then 'resolved' when 'A' then 'partly_addressed'
          when 'N' then case when l_partkey % 2 = 0 then 'unresolved' else 'unclear' end end end as resolution,
        l_partkey % 4 as segment_id,
        case when l_linenumber % 4 >= 2 and l_quantity > 30 then l_suppkey % 4 end as response_segment_id,
        case when l_linenumber % 4 = 2 and l_returnflag = 'R' and l_quantity > 10 then (l_partkey + 1) % 4 end as resolution_segment_id
      from {{lineitem}}""",
    "verdicts": f"""
      select 'C' || cast(l_orderkey as string) as call_id, {_POS} as item_pos,
        case when l_suppkey % 10 < 7 then 'supported' when l_suppkey % 10 < 9 then 'overstated' else 'unsupported' end as verdict,
        case when l_suppkey % 20 = 7 then 'partly_addressed' when l_suppkey % 20 = 8 then 'unresolved' end as corrected_resolution,
        'reason ' || cast(l_suppkey % 3 as string) as reason
      from {{lineitem}}""",
    "purpose_verdicts": """
      select 'C' || cast(o_orderkey as string) as call_id,
        case when o_custkey % 8 < 6 then 'supported' else 'unsupported' end as verdict,
        case when o_custkey % 16 = 6 then 'administrative' when o_custkey % 16 = 7 then 'sales' when o_custkey % 16 = 14 then 'unclear'
          end as corrected_type,
        case when o_orderstatus <> 'P' then o_orderkey % 4 end as purpose_segment_id, 'purpose ' || o_orderstatus as reason
      from {orders}""",
    "codings": f"""
      select cast(c_custkey as string) as lead, {pick('c_custkey % 9', STANCES)} as stance,
        'detail ' || cast(c_custkey % 5 as string) as detail,
        case when c_custkey % 9 = 1 then 'condition ' || cast(c_custkey % 4 as string) end as condition,
        case when c_custkey % 9 = 1 then case cast(floor(c_custkey / 9) as bigint) % 3 when 0 then 'yes' when 1 then 'no'
          else 'unclear' end end as condition_can_be_met,
        case when c_custkey % 9 = 1 and c_custkey % 4 > 0 then 'because ' || cast(c_custkey % 4 as string) end as condition_reason,
        c_custkey % 13 = 0 as refused_after_commitment, c_acctbal < -500 as status_needed,
        case when c_acctbal < -500 and c_custkey % 4 > 0 then 'Calls show an enrolled learner' end as status_reason,
        case when c_mktsegment = 'MACHINERY' then 'outside_target' when c_mktsegment = 'HOUSEHOLD' then 'not_asked'
          else 'in_target' end as target_value,
        case when c_mktsegment = 'MACHINERY' then 'Non-IT background' end as target_reason,
        case c_custkey % 6 when 0 then 'Counsellor sends the discount link today.' when 1 then 'If the manager approves the discount, send the fee.'
          when 2 then 'Ask him about the trial.' when 3 then 'The model suggests a call next week.'
          when 4 then 'Send the details to a@b.com.' else 'Counsellor sends the final price once the lead confirms.' end as next_action,
        'Intent of ' || c_mktsegment as buying_intent,
        case c_custkey % 4 when 0 then 'Not asked' when 1 then 'Years not stated' else cast(c_custkey % 15 as string) || ' years' end as experience,
        'coder ' || cast(c_custkey % 3 as string) as coder, c_nationkey as nation_id,
        'role ' || cast(c_custkey % 8 as string) as role, case c_custkey % 3 when 0 then 'Not asked' else cast(c_custkey % 30 as string) || ' LPA' end as ctc,
        'city ' || cast(c_nationkey as string) as location, 'Hello again' as opener, 'What holds the decision?' as question,
        case c_custkey % 10 when 0 then 'Shall I hold the early-bird price?' else 'May we call after the approval?' end as ask,
        'needs ' || lower(c_mktsegment) as strength, case c_custkey % 12 when 0 then repeat('many words ', 13) else 'few facts' end as weakness,
        'a named batch' as opportunity, case c_custkey % 14 when 0 then 'her budget' else 'the budget' end as threat
      from {{customer}}""",
    # One decisive and up to two objection evidences per lead, citing the lead's own calls.
    "coding_evidence": """
      select cast(o_custkey as string) as lead, case o_orderkey % 5 when 0 then 'status_check' when 1 then 'target_check'
          when 2 then 'stance' else 'objection' end as place,
        o_orderkey as evidence_no, 'C' || cast(case when o_orderkey % 50 = 3 then o_orderkey + 1 else o_orderkey end as string) as call_id,
        substr(cast(o_orderdate as string), 1, 8) || case when o_orderkey % 41 = 0 then '99' else substr(cast(o_orderdate as string), 9, 2) end as date,
        o_orderkey % 4 as segment_id, (o_orderkey % 4) * 20.0 + case when o_orderkey % 37 = 0 then 3.0 else 0.5 end as start_seconds,
        case o_orderkey % 7 when 0 then '' when 1 then 'one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen'
          else 'the price is ' || o_orderpriority end as quote,
        case o_orderkey % 3 when 0 then 'price' when 1 then 'format' else 'timing' end as topic,
        case o_orderkey % 2 when 0 then 'open' else 'resolved' end as status, 'objection ' || o_orderstatus as detail
      from {orders}""",
    "segments": """
      select 'C' || cast(conv_id as string) as call_id, turn as segment_id,
        case role when 'user' then 'prospect' when 'assistant' then 'agent' else 'other' end as role, text,
        turn * 20.0 as start, turn * 20.0 + 18.0 as end_at, conv_id, turn
      from {conversations}""",
    # Which calls have an extraction, and what it says about the call as a whole.
    "extractions": """
      select 'C' || cast(o_orderkey as string) as call_id, o_orderkey % 13 > 0 as analysed, 'Summary of ' || o_orderstatus as summary,
        'Follow up ' || cast(o_orderkey % 21 as string) as next_action, o_orderkey % 13 as model_no
      from {orders}""",
    # Quotes cited from conversation turns: inside the turn, running into the next one, only in the next one, with
    # fillers and punctuation, or altered.
    "citations": """
      select 'C' || cast(c.conv_id as string) as call_id, c.turn as segment_id, c.conv_id * 100 + c.turn as citation_id,
        case (c.conv_id + c.turn) % 5 when 0 then substr(c.text, 3, 40)
          when 1 then substr(c.text, greatest(cast(length(c.text) - 24 as int), 1), 25) || ' ' || substr(coalesce(n.text, 'nothing'), 1, 25)
          when 2 then substr(coalesce(n.text, 'nothing more'), 1, 30)
          when 3 then 'um ' || substr(c.text, 1, 20) || '!' else 'Zzz ' || substr(c.text, 1, 25) end as quote
      from {conversations} c left join {conversations} n on n.conv_id = c.conv_id and n.turn = c.turn + 1""",
    # One extracted item per line as JSON text, some breaking the schema.
    "item_json": f"""
      select 'C' || cast(l_orderkey as string) as call_id, {_POS} as item_pos,
        '{{{{"field": "' || case when l_suppkey % 17 = 0 then 'salary' else {pick(f'l_partkey % {len(FACT_FIELDS)}', FACT_FIELDS)} end
        || '", "value": "' || case when l_suppkey % 19 = 0 then '' when l_suppkey % 19 = 1 then repeat('long ', 90) else 'value' end
        || '", "evidence": {{{{"segment_id": ' || cast(l_partkey % 6 - 1 as string) || ', "quote": "'
        || case when l_suppkey % 23 = 0 then '  ' else 'said so' end || '"}}}}'
        || case when l_suppkey % 29 = 0 then ', "probability": 0.9' else '' end || '}}}}' as body
      from {{lineitem}}""",
    # Every call has one short line, so citations resolve but for calls whose line has another id.
    "lines": """
      select 'C' || cast(o_orderkey as string) as call_id,
        case when o_orderkey % 11 = 0 then 9 else o_orderkey % 4 end as segment_id,
        'Okay, the price is ' || o_orderpriority || '.' as text, (o_orderkey % 4) * 20.0 as start, (o_orderkey % 4) * 20.0 + 18.0 as end_at
      from {orders}""",
    # Three systems' short texts for the same stretch of speech.
    "votes": f"""
      select 'C' || cast(l_orderkey as string) as call_id, {_POS} as segment_pos, 'w ' || l_returnflag as whisper,
        case when l_partkey % 3 = 0 then 'W ' || l_returnflag || '.' else 'w ' || l_linestatus end as gemini,
        case when l_suppkey % 4 = 0 then 'w' || l_returnflag when l_suppkey % 4 = 1 then 'w ' || l_linestatus
          else 'x ' || cast(l_suppkey % 2 as string) end as sarvam,
        case when l_suppkey % 6 = 5 then null else 'spk:' || cast(l_suppkey % 3 as string) end as speaker,
        l_partkey % 1000 as start_at
      from {{lineitem}}""",
    "ledger": """
      select event_id, ts as recorded_at, 'C' || cast(user_id as string) as call_id,
        case event_type when 'view' then 'transcribe' when 'click' then 'extract' when 'purchase' then 'remote_usage'
          when 'signup' then 'resolve' else 'verify' end as stage,
        case when event_type = 'error' then 'failed' when event_id % 17 = 0 then 'failed' else 'success' end as status,
        value as external_cost_inr, value * 0.5 as wall_seconds, event_id % 5 + 1 as audio_seconds,
        case when event_id % 3 = 0 then 'labelled-v1' else 'local-v1' end as system,
        event_id % 900 as input_tokens, event_id % 70 as output_tokens, props
      from {events}""",
    "budget_events": """
      select event_id, ts, 'B' || cast(user_id % 7 as string) as budget_id, 'R' || cast(event_id as string) as request_id,
        value as reserve_inr,
        case event_type when 'view' then 'usage_reported' when 'click' then 'rejected_not_billed'
          when 'error' then 'uncertain_reserve_retained' when 'signup' then 'reserved' else 'usage_reported' end as final_status,
        case event_type when 'view' then value * 0.5 when 'click' then 0.0 when 'purchase' then value * 1.25 else value end as final_inr
      from {events}""",
    "reviews": """
      select doc_id, case when quality = 1 then 'Yes' else 'no ' end as correct, case when toxic = 0 then 'reviewer' else '' end as reviewer,
        case when toxic = 0 then '2026-10-02' end as reviewed_at from {labels}""",
    # A call export as text, with rows that break each rule.
    "raw_calls": """
      select o_orderkey + 2 as source_row,
        case o_orderkey % 19 when 0 then '0h:60m:1s' when 1 then 'bad' when 2 then null when 3 then '0h:0m:0s'
          else cast(cast(floor(o_totalprice / 3600 / 400) as bigint) as string) || 'h:' || cast(o_custkey % 60 as string) || 'm:'
            || cast(o_orderkey % 60 as string) || 's' end as duration_text,
        case o_orderkey % 23 when 0 then null when 1 then '12.5' when 2 then cast(o_custkey as string) || '.0'
          when 3 then ' ' || cast(o_custkey as string) || ' ' when 4 then 'true' else cast(o_custkey as string) end as lead_raw,
        case o_orderkey % 29 when 0 then 'http://recordings.example.com/' || cast(o_orderkey as string)
          when 1 then 'https://other.example.com/' || cast(o_orderkey as string)
          when 2 then 'https://user:pw@recordings.example.com/' || cast(o_orderkey as string)
          when 3 then 'https://recordings.example.com:8443/' || cast(o_orderkey as string)
          when 4 then 'https://recordings.example.com:443/' || cast(o_orderkey as string) when 5 then 'not a url'
          else 'https://recordings.example.com/' || cast(o_orderkey - o_orderkey % 3 as string) end as recording_url,
        case o_orderkey % 31 when 0 then 'n/a' else cast(o_orderdate as string) end as created_on,
        case o_orderkey % 37 when 0 then 'Maybe' when 1 then '' when 2 then null when 3 then 'Yes' else 'No' end as flag,
        o_orderkey % 41 = 0 as is_formula, o_orderstatus as status, 'Agent ' || cast(o_orderkey % 97 as string) as salesperson
      from {orders}""",
    "texts": "select doc_id, text, lang, source from {documents}",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")


def _inputs(name):
    return [t for t in TABLES if "{" + t + "}" in SQL[name]]


class Tables:
    """Reads the Parquet tables of one folder, raw or bound."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, table):
        return widen(self.spark.read.parquet(f"{self.folder}/{table}.parquet"))

    def bind(self, name):
        return self.spark.sql(SQL[name], **{t: self.raw(t) for t in _inputs(name)})

    __getattr__ = bind


def ctes(*names):
    """The same bindings as a WITH list for DuckDB."""
    parts = []
    for name in names:
        parts.append(f"{name} as ({SQL[name].format(**{t: t for t in _inputs(name)})})")
    return ",\n".join(parts)
