"""Grading, guards and publication of the worklist."""

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import guards
from ..plans import worklist as wl
from ..sources.bindings import ctes
from .base import ORACLE, query
from .journeys import LIVE_SQL, OUTCOMES

GRADED = f"""{OUTCOMES}, {LIVE_SQL}, cutoff as (select max(created_on)::date as as_of from calls),
coded as (select c.*, case when stance not in ('none', 'recording_unusable') then l.live_at::date end as live_date,
   case when stance not in ('none', 'recording_unusable') then l.live_call_id end as live_call_id, coalesce(l.attempts_since, 0) as attempts_since
  from codings c left join last_live l on l.lead = c.lead),
dated as (select *, date_diff('day', live_date, as_of) as days_since,
   stance = 'commitment' or (stance = 'conditional_commitment' and coalesce(condition_can_be_met = 'yes', false)) as committed
  from coded, cutoff where lead in (select lead from outcomes where not any_yes)),
graded as (select *, case when status_needed then 'Check status' when stance = 'recording_unusable' then 'Recording unusable: confirm status'
   when stance = 'none' then 'Not reached' when target_value = 'outside_target' then 'Outside target'
   when stance in ('declined', 'product_not_sold') or (stance = 'conditional_commitment' and condition_can_be_met = 'no') then 'Cold: declined'
   when committed and not refused_after_commitment and days_since <= 45 then 'Hot' when days_since > 90 then 'Dormant: reconfirm' else 'Warm' end as category,
  case when status_needed then status_reason when stance = 'recording_unusable' then 'The recorded calls have no usable audio, so nothing is known'
   when stance = 'none' then 'No conversation in ' || attempts_since || ' recorded call' || case when attempts_since = 1 then '' else 's' end
   when target_value = 'outside_target' then target_reason when stance in ('declined', 'product_not_sold') then detail
   when stance = 'conditional_commitment' and condition_can_be_met = 'no' then 'Condition the company cannot meet: ' || condition
   when committed and not refused_after_commitment and days_since <= 45
     then detail || coalesce(' (condition: ' || condition || ')', '') || '; ' || days_since || ' days before the data cutoff'
   when days_since > 90 then 'Last conversation ' || days_since || ' days before the data cutoff; information is stale'
   when committed then 'Re-open: commitment from ' || coalesce(days_since || ' days before the data cutoff', '') else detail end as reason from dated)"""
BASE = ctes("calls", "codings")


def graded(t):
    return wl.graded(t.codings, t.calls)


@query("worklist_categories", f"with {BASE}, {GRADED} select lead, category, reason, cast(days_since as int) as days_since, cast(as_of as varchar) as as_of from graded")
def worklist_categories(t):
    """Every open lead graded, in published order."""
    return wl.published_order(graded(t)).select("lead", "category", "reason", "days_since", F.col("as_of").cast("string").alias("as_of"))


@query("category_counts", f"""with {BASE}, {GRADED} select n.category, count(g.lead) as leads from (values {', '.join(f"('{c}')" for c in wl.CATEGORIES)}) n(category)
 left join graded g on g.category = n.category group by 1""")
def category_counts(t):
    return wl.category_counts(graded(t))


@query("act_now", f"""with {BASE}, {GRADED} select lead, category, cast(days_since as int) as days_since, next_action from graded
 where category in ('Hot', 'Check status', 'Recording unusable: confirm status') or (category = 'Warm' and days_since <= 30)""")
def act_now(t):
    return wl.act_now(graded(t)).select("lead", "category", "days_since", "next_action")


@query("narrative_counts", f"""with {BASE}, {GRADED}, f as (select *, category not in ('Not reached', 'Recording unusable: confirm status') as reached_,
   next_action || ' ' || reason as said from graded)
 select count(*) filter (reached_) as reached, count(*) filter (reached_ and (experience = 'Not asked' or lower(experience) like '%not stated%')) as not_asked,
  count(*) filter (category = 'Not reached') as never, count(*) filter (condition is not null and condition_can_be_met = 'yes') as waiting,
  count(*) filter (regexp_matches(said, '(?i)discount|final price|price approval|approve.{{0,30}}price|price.{{0,20}}approv')) as pricing from f""")
def narrative_counts(t):
    return wl.narrative_counts(graded(t))


HUMAN = lambda d: f"(day({d}) || ' ' || ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][month({d})] || ' ' || year({d}))"
CLOCK = lambda s: f"printf('%02d:%02d', cast(floor({s} / 60) as bigint), cast(floor({s}) as bigint) % 60)"
CITE = lambda label, a: (f"{label} || ': call of ' || coalesce({HUMAN(a + '.day')}, {a}.date) || coalesce(' ' || strftime({a}.created_on, '%H:%M'), '') || ', minute ' || "
                         f"{CLOCK(a + '.start_seconds')} || ': “' || {a}.quote || '”'")
CITED = """cited as (select e.*, try_cast(e.date as date) as day, c.created_on from coding_evidence e left join calls c on c.call_id = e.call_id)"""
PLACE = "case category when 'Check status' then 'status_check' when 'Outside target' then 'target_check' else 'stance' end"
CONTEXT = "case category " + " ".join(f"when '{k}' then '{v.replace(chr(39), chr(39) * 2)}'" for k, v in wl.HISTORICAL_CONTEXT.items()) + " end"


@query("worklist_rows", f"""with {ctes('calls', 'codings', 'coding_evidence')}, {GRADED}, {CITED},
 dec as (select c.* from cited c join graded g on g.lead = c.lead and c.place = {PLACE} qualify row_number() over (partition by c.lead order by evidence_no) = 1),
 obj as (select c.*, row_number() over (partition by c.lead order by evidence_no) as rn from cited c where place = 'objection' and status = 'open'),
 listed as (select lead, cast(floor((rn - 1) / 200) + 1 as bigint) as part,
   string_agg(upper(left(topic, 1)) || lower(substr(topic, 2)) || ': ' || detail, chr(10) order by evidence_no) as open_objections from obj group by 1, 2),
 proof as (select g.lead, list_filter([(select {CITE("'Why'", 'd')} from dec d where d.lead = g.lead),
   (select {CITE("'Objection (' || o.topic || ')'", 'o')} from obj o where o.lead = g.lead and rn = 1),
   (select {CITE("'Objection (' || o.topic || ')'", 'o')} from obj o where o.lead = g.lead and rn = 2)], lambda x: x is not null) as p from graded g)
 select g.lead, coalesce(l.part, 1) as part, category as priority, reason,
  case when category = 'Dormant: reconfirm' then 'Message the lead to reconfirm interest before any call. If the lead replies: ' else '' end || next_action as next_action,
  'Open: ' || opener || chr(10) || 'Ask: ' || question || chr(10) || 'Close: ' || ask as what_to_say, role, ctc, location,
  'S: ' || strength || chr(10) || 'W: ' || weakness || chr(10) || 'O: ' || opportunity || chr(10) || 'T: ' || threat as swot,
  case when len(p.p) = 0 then 'No usable recording' else array_to_string(list_transform(list_filter(p.p, lambda x, i: list_position(p.p, x) = i), lambda x: x), chr(10)) end as evidence,
  {CONTEXT} as historical_context,
  case when live_date is null then 'No usable conversation' else {HUMAN('live_date')} || ' (' || days_since || ' days before cutoff)' end as last_conversation,
  buying_intent || coalesce(' Condition: ' || condition || ' (' || case condition_can_be_met when 'yes' then 'a decision the company controls'
    when 'no' then 'the company does not offer this' when 'unclear' then 'depends on the lead' else 'unclear' end || ').', '') as buying_intent, experience,
  coalesce(open_objections, 'None open') as open_objections, 'Recording validation pending' as validation
 from graded g join proof p on p.lead = g.lead left join listed l on l.lead = g.lead""")
def worklist_rows(t):
    return wl.worklist_rows(graded(t), t.coding_evidence, t.calls)


@query("undated_citations", f"with {ctes('coding_evidence')} select lead, evidence_no, place, date from coding_evidence where try_cast(date as date) is null")
def undated_citations(t):
    """Citations that stop a publication until their date is mended."""
    return wl.undated(t.coding_evidence)


SUMMARY = "'Call about ' || status || ' for ' || cast(cast(floor(price) as bigint) as string)"
TYPE_CASE = "case conversation_type " + " ".join(f"when '{k}' then '{v}'" for k, v in wl.TYPE_LABEL.items()) + " end"
CALL_ROWS = f"""shown as (select lead, call_id, created_on, {HUMAN('created_on')} as date, {TYPE_CASE} as type,
  case when duration_seconds < 30 then 'under 1 min' else cast(greatest(1, round_even(duration_seconds / 60.0, 0)) as int) || ' min' end as length,
  {SUMMARY} as summary from calls)"""


def summaries(t):
    return t.calls.select("call_id", F.expr(SUMMARY).alias("summary"))


@query("call_rows", f"with {ctes('calls')}, {CALL_ROWS} select * from shown")
def call_rows(t):
    return wl.call_rows(t.calls, summaries(t))


@query("journey_rows", f"""with {ctes('calls')}, {OUTCOMES}, {CALL_ROWS}, n as (select *, row_number() over (partition by lead order by created_on, call_id) as rn from shown)
 select n.lead, cast(floor((rn - 1) / 200) + 1 as bigint) as part, string_agg(date || ' · ' || type || ' · ' || length || ': ' || summary, chr(10) order by rn) as journey,
  case when all_yes then 'Customer (CRM)' when any_yes then 'Unclear: mixed CRM flags' else 'Open lead' end as status, o.calls,
  {HUMAN('f.lo')} as first_call, {HUMAN('f.hi')} as last_call
 from n join outcomes o on o.lead = n.lead join (select lead, min(created_on) as lo, max(created_on) as hi from calls group by lead) f on f.lead = n.lead
 group by n.lead, 2, o.calls, all_yes, any_yes, lo, hi""")
def journey_rows(t):
    return wl.journey_rows(t.calls, summaries(t))


STATEMENT = """case place when 'status_check' then 'status: ' || coalesce(status_reason, 'None') when 'target_check' then 'exclusion: ' || coalesce(target_reason, 'None')
  else 'stance: ' || g.detail end"""
CLAIMS = f"""claims as (select g.lead, category, {STATEMENT} as claim, e.date, {CLOCK('e.start_seconds')} as timestamp, e.quote
   from coding_evidence e join graded g on g.lead = e.lead where e.place = {PLACE}
  union all select g.lead, category, 'objection ' || topic || ': ' || e.detail, e.date, {CLOCK('e.start_seconds')}, e.quote
   from coding_evidence e join graded g on g.lead = e.lead where place = 'objection' and e.status = 'open' and category in ('Hot', 'Warm', 'Check status'))"""
PRIOR = """prior as (select lead, claim, quote, verdict, note, reviewer, reviewed_at from (select distinct lead, claim, quote from claims) d,
  (select 'Confirmed' as verdict, 'listened' as note, 'reviewer' as reviewer, '2026-10-02' as reviewed_at) v where cast(lead as bigint) % 4 > 0)"""
SHEET = """sheet as (select c.*, coalesce(p.verdict, '') as verdict, coalesce(p.note, '') as note, coalesce(p.reviewer, '') as reviewer,
  coalesce(p.reviewed_at, '') as reviewed_at from claims c left join prior p on p.lead = c.lead and p.claim = c.claim and p.quote = c.quote)"""
REVIEW = f"with {ctes('calls', 'codings', 'coding_evidence')}, {GRADED}, {CLAIMS}, {PRIOR}, {SHEET}"


def prior_signatures(claims):
    """Three of four leads have their claims signed."""
    return claims.select("lead", "claim", "quote").distinct().filter(F.col("lead").cast("bigint") % 4 > 0).select(
        "*", F.lit("Confirmed").alias("verdict"), F.lit("listened").alias("note"), F.lit("reviewer").alias("reviewer"), F.lit("2026-10-02").alias("reviewed_at"))


def sheet(t):
    claims = wl.review_claims(graded(t), t.coding_evidence)
    return wl.review_sheet(claims, prior_signatures(claims))


@query("review_sheet", f"{REVIEW} select * from sheet")
def review_sheet(t):
    return sheet(t)


@query("review_status", f"{REVIEW} select count(*) as claims, count(*) filter (reviewer <> '') as signed, count(*) = count(*) filter (reviewer <> '') as complete from sheet")
def review_status(t):
    return wl.review_status(sheet(t))


@query("confirmed_leads", f"{REVIEW} select lead from sheet group by lead having bool_and(reviewer <> '' and lower(trim(verdict)) = 'confirmed')")
def confirmed_leads(t):
    return wl.confirmed_leads(sheet(t))


@query("export_meta", f"""with {ctes('calls', 'codings', 'coding_evidence', 'reviews')}, {GRADED}, {CLAIMS}, {PRIOR}, {SHEET},
 a as (select count(*) filter (reviewer <> '' and reviewed_at is not null) as n, count(*) as total from reviews), s as (select count(*) as claims, count(*) filter (reviewer <> '') as signed from sheet)
 select (select count(*) from graded) as leads, (select cast(max(as_of) as varchar) from graded) as as_of, (select count(distinct lead) from calls) as journeys, (select count(*) from calls) as calls,
  claims, signed, claims = signed and claims > 0 as claims_complete, a.n = total as audit_complete, a.n as audit_reviewed, not (claims = signed and claims > 0 and a.n = total) as review_draft from a, s""")
def export_meta(t):
    """The publication's meta row."""
    from ..operators.quality import validation_status
    claims = wl.review_claims(graded(t), t.coding_evidence)
    return wl.export_tables(t.codings, t.calls, t.coding_evidence, summaries(t), prior_signatures(claims), validation_status(t.reviews))["meta"]


NORM = lambda s: f"trim(regexp_replace(regexp_replace(lower({s}), '[^\\p{{L}}\\p{{N}}_\\s'']', ' ', 'g'), '\\s+', ' ', 'g'))"


@query("coding_evidence_problems", f"""with {ctes('calls', 'lines', 'coding_evidence')},
 j as (select e.*, c.call_id as own, cast(c.created_on::date as varchar) as call_date, l.start as line_start, l.text as line_text from coding_evidence e
   left join calls c on c.call_id = e.call_id and c.lead = e.lead left join lines l on l.call_id = e.call_id and l.segment_id = e.segment_id)
 select lead, evidence_no, place, 'call is not this lead''s' as problem from j where own is null
 union all select lead, evidence_no, place, 'date differs from the call date' from j where own is not null and date <> call_date
 union all select lead, evidence_no, place, 'segment not in call' from j where own is not null and line_text is null
 union all select lead, evidence_no, place, 'start differs from the segment start' from j where own is not null and abs(line_start - start_seconds) > 2
 union all select lead, evidence_no, place, 'quote is not verbatim' from j where own is not null and line_text is not null
   and ({NORM('quote')} = '' or not contains({NORM('line_text')}, {NORM('quote')}))
 union all select lead, evidence_no, place, 'quote longer than 15 words' from j where own is not null and line_text is not null and len(regexp_extract_all(quote, '\\S+')) > 15""")
def coding_evidence_problems(t):
    return guards.evidence_problems(t.coding_evidence, t.calls, t.lines)


LONG_TEXTS = " union all ".join(f"select lead, '{place}' as place, {column} as text from codings where {column} is not null" for place, column in wl.CLIENT_TEXTS.items())


W_ = lambda words: f"(^|[^\\p{{L}}\\p{{N}}_])({words})([^\\p{{L}}\\p{{N}}_]|$)"
SQL_BANNED = W_("model|ai|gemini|extraction|signal|segment|cohort|h[eo]ld[- ]?out|development|fingerprint|transcript")
SQL_PRONOUNS = W_("he|she|him|her|his|hers|himself|herself")
SQL_CONTACT = f"https?://|www\\.|@[a-z0-9-]+\\.|{W_('[0-9]{10}')}|\\+91"
SQL_RELATIVE = W_("(this|next|coming) (week|weekend|month)|today|tomorrow|tonight|right away|immediately")
SQL_OFFER = f"discount|{W_('offer(ed|s)?')}|webinar price|early[- ]?bird|{W_('trial')}|pre-?book|waiver|% off|special price|lower price|price nearer|cheaper"
SQL_CONDITIONAL = ("approv|if (it is |still |currently )?(valid|available|open|allowed)|confirm|current (fee|price|offer)|still (valid|available|open)|whether")
SQL_INTERNAL = f"gemini|whisper|sarvam|saaras|fingerprint|h[eo]ld[- ]?out|development (split|calls?)|{W_('c[0-9a-f]{16}')}|https?://|{W_('[a-z]+_[a-z_]+')}"
no_negated = lambda s: f"regexp_replace(lower({s}), '(not |n''t |never )offer(ed|s)?', ' ', 'g')"
OFFER_RULE = lambda s: f"(regexp_matches({no_negated(s)}, '{SQL_OFFER}') and not regexp_matches(lower({s}), '{SQL_CONDITIONAL}'))"
hit = lambda s, rx: f"regexp_matches(lower({s}), '{rx}')"
word = lambda s, rx: f"regexp_extract({s}, '(?i){rx}', 2)"


@query("coding_wording_problems", f"""with {ctes('codings')}, long as ({LONG_TEXTS})
 select lead, place, 'internal word ' || {word('text', SQL_BANNED)} as problem from long where {hit('text', SQL_BANNED)}
 union all select lead, place, 'gendered pronoun ' || {word('text', SQL_PRONOUNS)} from long where {hit('text', SQL_PRONOUNS)}
 union all select lead, place, 'contact detail ' || regexp_extract(text, '(?i)@[a-z0-9-]+\\.') from long where {hit('text', SQL_CONTACT)}
 union all select lead, place, 'relative timing ' || {word('text', SQL_RELATIVE)} from long where place = 'next_action' and {hit('text', SQL_RELATIVE)}
 union all select lead, place, 'a discount, offer or trial must be conditional on current approval' from long where (place = 'next_action' or place like 'what_to_say%') and {OFFER_RULE('text')}
 union all select lead, place, 'over 25 words' from long where place like 'swot%' and len(regexp_extract_all(text, '\\S+')) > 25
 union all select lead, place, 'over 50 words' from long where place = 'next_action' and len(regexp_extract_all(text, '\\S+')) > 50""")
def coding_wording_problems(t):
    return guards.wording_problems(wl.client_texts(t.codings))


@query("coding_name_problems", f"""with {ctes('calls', 'leads', 'codings')}, names as (select lead, unnest(regexp_extract_all(lower(segment), '[a-z]{{3,}}')) as word from leads),
 long as ({LONG_TEXTS}),
 words as (select distinct lead, place, unnest(regexp_extract_all(lower(text), '[a-z]{{3,}}')) as word from long)
 select distinct w.lead, place, 'personal name ' || w.word as problem from words w join names n on n.lead = w.lead and n.word = w.word""")
def coding_name_problems(t):
    """The segment word plays the lead's name: buying_intent repeats it."""
    names = guards.tokens(t.leads, ["lead"], F.col("segment"), r"[a-z]{3,}")
    return guards.name_problems(wl.client_texts(t.codings), names)


# The coded day of the last live call; every 43rd lead's coder wrote the day after.
CODED_LIVE = "live_at::date + case when lead::bigint % 43 = 0 then 1 else 0 end"
STANCE_SQL = f"""j as (select c.*, l.live_call_id, exists (select 1 from calls k where k.call_id = l.live_call_id and k.lead = c.lead and k.created_on::date = {CODED_LIVE.replace('lead::', 'c.lead::')}) as call_matches,
   exists (select 1 from coding_evidence e where e.lead = c.lead and e.place = 'target_check') as has_target,
   exists (select 1 from coding_evidence e where e.lead = c.lead and e.place = 'status_check') as has_status from codings c left join last_live l on l.lead = c.lead)
 select lead, 'a conditional commitment needs condition, condition_can_be_met and condition_reason' as problem from j
   where stance = 'conditional_commitment' and (condition is null or condition_can_be_met is null or condition_reason is null)
 union all select lead, 'a last live conversation is given for a lead nobody reached' from j where stance in ('none', 'recording_unusable') and live_call_id is not null
 union all select lead, 'a stance other than none needs the last live conversation' from j where stance not in ('none', 'recording_unusable', 'declined') and live_call_id is null
 union all select lead, 'last_live_conversation does not match one of the lead''s calls' from j where live_call_id is not null and not call_matches
 union all select lead, 'outside_target needs a reason and evidence' from j where target_value = 'outside_target' and (target_reason is null or not has_target)
 union all select lead, 'a status check needs a reason and evidence' from j where status_needed and (status_reason is null or not has_status)"""


def coded_live(t):
    """The last live call of each lead with the day its coder wrote."""
    from ..operators.journeys import last_live
    day = F.date_add(F.to_date("live_at"), F.when(F.col("lead").cast("bigint") % 43 == 0, 1).otherwise(0))
    return last_live(t.calls).withColumn("coded_day", day.cast("string"))


@query("coding_stance_problems", f"with {ctes('calls', 'codings', 'coding_evidence')}, {OUTCOMES}, {LIVE_SQL}, {STANCE_SQL}")
def coding_stance_problems(t):
    marks = t.coding_evidence.groupBy("lead").agg(F.some(F.col("place") == "target_check").alias("has_target_evidence"),
                                                  F.some(F.col("place") == "status_check").alias("has_status_evidence"))
    rows = t.codings.join(coded_live(t), "lead", "left").join(marks, "lead", "left").na.fill(False, ["has_target_evidence", "has_status_evidence"])
    own = t.calls.select(F.col("call_id").alias("live_call_id"), F.col("lead").alias("of"), F.to_date("created_on").cast("string").alias("on"))
    rows = rows.join(own, "live_call_id", "left").withColumn("call_matches", (F.col("of") == F.col("lead")) & (F.col("on") == F.col("coded_day")))
    return guards.stance_problems(rows)


# One file per lead: the first evidence of each place and all objections; some files name another lead, break the schema or miss a call.
FIRST = """first as (select * from coding_evidence where place <> 'objection' qualify row_number() over (partition by lead, place order by evidence_no) = 1
  union all select * from coding_evidence where place = 'objection')"""


def coding_files(t):
    """(lead, body): the codings as JSON files."""
    cite = F.struct("call_id", "date", "segment_id", "start_seconds", "quote")
    cited = t.coding_evidence.withColumn("e", cite)
    at = lambda place: F.min_by(F.when(F.col("place") == place, F.col("e")), F.when(F.col("place") == place, F.col("evidence_no")))
    listed = F.array_sort(F.collect_list(F.when(F.col("place") == "objection", F.struct("evidence_no", F.struct("topic", "detail", "status", F.col("e").alias("evidence")).alias("o")))))
    proof = cited.groupBy("lead").agg(at("status_check").alias("status_e"), at("target_check").alias("target_e"), at("stance").alias("stance_e"), listed.alias("listed"))
    read = t.calls.where(F.col("source_row") % 50 != 7).groupBy("lead").agg(F.array_sort(F.collect_list("call_id")).alias("calls_read"))
    rows = t.codings.join(proof, "lead", "left").join(read, "lead", "left").join(coded_live(t), "lead", "left")
    number, nothing = F.col("lead").cast("bigint"), F.lit(None).cast("struct<call_id: string, date: string, segment_id: bigint, start_seconds: double, quote: string>")
    item = lambda c: F.struct(F.col(c).alias("display"), nothing.alias("evidence"))
    live = F.when(F.col("live_call_id").isNotNull(), F.struct(F.col("coded_day").alias("date"), F.col("live_call_id").alias("call_id")))
    profile = F.struct(item("experience").alias("experience"), item("role").alias("role"), item("ctc").alias("ctc"), item("location").alias("location"))
    body = F.struct(
        F.lit("lead-coding-v1").alias("schema"), F.when(number % 31 == 0, F.concat("lead", F.lit("x"))).otherwise(F.col("lead")).alias("lead"), "coder",
        F.coalesce("calls_read", F.array().cast("array<string>")).alias("calls_read"),
        F.struct(F.col("status_needed").alias("needed"), F.col("status_reason").alias("reason"), F.col("status_e").alias("evidence")).alias("status_check"), profile.alias("profile"),
        F.struct(F.when(number % 37 == 0, "me").otherwise("self").alias("value"), nothing.alias("evidence")).alias("learner"),
        F.struct(F.col("target_value").alias("value"), F.col("target_reason").alias("reason"), F.col("target_e").alias("evidence")).alias("target_check"),
        F.struct(F.col("stance").alias("value"), "detail", "condition", "condition_can_be_met", "condition_reason", F.col("stance_e").alias("evidence")).alias("stance"),
        "refused_after_commitment", live.alias("last_live_conversation"), F.coalesce("attempts_since", F.lit(0)).alias("attempts_since_last_live"), "buying_intent",
        F.lit(None).cast("string").alias("their_next_step"), F.coalesce(F.transform("listed", lambda x: x["o"]), F.array()).alias("objections"),
        F.struct("strength", "weakness", "opportunity", "threat").alias("swot"), "next_action", F.struct("opener", "question", "ask").alias("what_to_say"))
    text = F.to_json(body, {"ignoreNullFields": "false"})
    return rows.select("lead", F.when(number % 41 == 0, F.concat(F.lit('{"age": 30, '), F.substring(text, 2, 1 << 30))).otherwise(text).alias("body"))


@query("check_coding", f"""with {ctes('calls', 'codings', 'leads', 'coding_evidence', 'lines')}, {FIRST}, good as (select lead from codings where lead::bigint % 37 > 0 and lead::bigint % 41 > 0),
 placed as (select *, case when place = 'objection' then 'objections[' || row_number() over (partition by lead, place order by evidence_no) - 1 || ']' else place end as at from first)
 select lead, 'learner.value' as place, 'schema: value not allowed' as problem from codings where lead::bigint % 37 = 0
 union all select lead, 'age', 'schema: unknown key' from codings where lead::bigint % 41 = 0
 union all select lead, 'lead', 'lead differs from the file''s' from good where lead::bigint % 31 = 0
 union all select distinct lead, 'calls_read', 'calls_read must list all calls of the lead' from calls where source_row % 50 = 7 and lead in (select lead from good)
 union all select p.lead, p.at, x.problem from ({ORACLE['coding_evidence_problems']}) x join placed p on p.lead = x.lead and p.evidence_no = x.evidence_no where p.lead in (select lead from good)
 union all select * from ({ORACLE['coding_wording_problems']}) where lead in (select lead from good)
 union all select * from ({ORACLE['coding_name_problems']}) where lead in (select lead from good)
 union all select lead, '', problem from ({ORACLE['coding_stance_problems']}) where lead in (select lead from good)""")
def check_coding(t):
    """Every rule for coding files at once; the segment word plays the lead's name."""
    from ..operators import schemas
    names = guards.tokens(t.leads, ["lead"], F.col("segment"), r"[a-z]{3,}")
    return schemas.check_coding(coding_files(t), t.calls, t.lines, names)


@query("unread_calls", f"""with {ctes('calls', 'coding_evidence')}, j as (select coalesce(c.lead, e.lead) as lead, c.call_id as have, e.call_id as said from calls c
   full join coding_evidence e on c.lead = e.lead and c.call_id = e.call_id)
 select lead, count(*) filter (said is null) as not_read, count(*) filter (have is null) as not_theirs from j group by lead having count(*) filter (said is null or have is null) > 0""")
def unread_calls(t):
    return guards.unread_calls(t.calls, t.coding_evidence.select("lead", "call_id"))


@query("coding_coverage", f"""with {ctes('calls', 'codings')}, {OUTCOMES} select o.lead, case when c.lead is null then 'not coded yet' else 'coded' end as state
 from outcomes o left join (select * from codings where stance <> 'open') c on c.lead = o.lead where not any_yes""")
def coding_coverage(t):
    """Worklist leads whose coding is missing are reported, not skipped."""
    from ..operators.journeys import outcomes
    codings = t.codings.filter(F.col("stance") != "open").select("lead", F.lit("coded").alias("state"))
    return outcomes(t.calls).filter(~F.col("any_yes")).select("lead").join(codings, "lead", "left").na.fill("not coded yet", ["state"])


@query("published_text_guard", f"""with {ctes('calls')}, {CALL_ROWS}, long as (select call_id, 'call_id' as "column", call_id as value from shown union all select call_id, 'type', type from shown
   union all select call_id, 'raw_type', conversation_type from calls union all select call_id, 'summary', summary from shown)
 select call_id, "column", regexp_extract(value, '[a-z]+_[a-z_]+') as match
 from long where {hit('value', SQL_INTERNAL)}""")
def published_text_guard(t):
    rows = wl.call_rows(t.calls, summaries(t)).join(t.calls.select("call_id", F.col("conversation_type").alias("raw_type")), "call_id")
    return guards.published_problems(rows, ["call_id"], ["call_id", "type", "raw_type", "summary"], [tx.INTERNAL_TEXT, tx.PRONOUNS]).select(
        "call_id", "column", "match")


@query("text_guards", f"""select doc_id, {hit('text', SQL_BANNED)} as banned, {hit('text', SQL_PRONOUNS)} as pronoun, {hit('text', SQL_CONTACT)} as contact,
 {hit('text', SQL_RELATIVE)} as relative_time, {OFFER_RULE('text')} as offer, {hit('text', SQL_INTERNAL)} as internal from documents""")
def text_guards(t):
    return guards.text_flags(t.texts)


@query("secret_scan", """with files as (select source || '/' || doc_id || case doc_id % 9 when 0 then '.wav' when 1 then '.md' when 2 then '/.env' when 3 then '/.env.example' else '.txt' end as path, text from documents
   union all select case page_id % 7 when 0 then 'data/' else 'site/' end || page_id || '.html', html from pages)
 select path, case when split_part(path, '/', 1) in ('data', 'outputs', 'models', '.venv') or regexp_matches(lower(path), '\\.(wav|ogg|mp3|flac|xlsx|docx|pdf)$')
   or (regexp_matches(path, '(^|/)\\.env[^/]*$') and not path like '%.env.example') then 'private file'
  when regexp_matches(text, 'https://recordings[.]example[.]com/\\S+') then 'recording link'
  when regexp_matches(text, '\\b(sk-proj-|gsk_)[A-Za-z0-9_-]{20,}|AIza[0-9A-Za-z_-]{35}|\\bAQ\\.[A-Za-z0-9_.-]{40,}') then 'api key'
  when regexp_matches(text, '(?i)\\b(token|secret|api_key|password)\\s*=\\s*"[0-9a-f]{16,}"') then 'secret' end as reason from files where reason is not null""")
def secret_scan(t):
    docs = t.raw("documents").select(F.expr("""source || '/' || doc_id || case doc_id % 9 when 0 then '.wav' when 1 then '.md' when 2 then '/.env'
        when 3 then '/.env.example' else '.txt' end""").alias("path"), F.col("text").alias("content"))
    pages = t.raw("pages").select(F.expr("case page_id % 7 when 0 then 'data/' else 'site/' end || page_id || '.html'").alias("path"), F.col("html").alias("content"))
    return guards.secret_scan(docs.unionByName(pages), "recordings.example.com")


def publication(t):
    """One publication of the given tables into a new folder: problems of codings are passed over here, as the tables plant them on purpose."""
    from ..operators.journeys import buyer_timing
    from ..operators.quality import validation_status
    from ..plans import patterns as pt, publication as pb
    from ..session import work_folder
    folder = work_folder(t.spark, "publication")
    holdout = t.leads.where(F.col("lead").cast("bigint") % 5 == 0).select("lead")
    record = pb.freeze(t.spark, folder, t.calls.agg(F.to_date(F.max("created_on")).cast("string")).first()[0], t.leads.select("lead"), holdout.limit(0), "1990-01-01T00:00:00")
    claims = wl.review_claims(graded(t), t.coding_evidence)
    actions = t.extractions.select("call_id", "next_action")
    objections = t.items.where("collection = 'objections'")
    tables = pb.tables_of(t.codings, t.calls, t.coding_evidence, summaries(t), prior_signatures(claims), validation_status(t.reviews), objections, actions, holdout,
                          t.leads.where(F.col("lead").cast("bigint") % 2 == 0).select("lead"), record, pt.past_lead_evidence(t.calls, t.items, t.profiles, t.profile_refs), buyer_timing(t.calls))
    coded = t.calls.groupBy("lead").agg(F.min("created_on").cast("string").alias("coded_at"))
    pb.publish(t.spark, tables, folder, record, {"Held-out leads coded before the freeze": pb.early_coded(coded, holdout, record)}, "1999-01-01T00:00:00")
    return folder


@query("publication_internal", f"""with {ctes('calls', 'codings')}, {GRADED} select lead, category, reason, coder, lead::bigint % 5 = 0 as holdout, case when lead::bigint % 2 = 0 then 'pilot' else 'non-buyer sample' end as source,
 sha256('["' || detail || '", "' || lead || '", "' || next_action || '", "' || stance || '"]') as coding_hash from graded""")
def publication_internal(t):
    """The internal record of the committed publication."""
    from ..plans import publication as pb
    return pb.published(t.spark, publication(t), "internal")


@query("publication_manifest", f"""with {ctes('calls', 'codings', 'coding_evidence')}, {GRADED} select name, rows from (
 select 'internal' as name, count(*) as rows from graded union all select 'calls', count(*) from calls union all select 'meta', 1 union all select 'timing', 1
 union all select 'categories', {len(wl.CATEGORIES)})""")
def publication_manifest(t):
    """Tables and rows the manifest names, as counted while they were written."""
    from ..plans import publication as pb
    return pb.manifest(t.spark, publication(t)).where(F.col("name").isin("internal", "calls", "meta", "timing", "categories")).select("name", "rows")


@query("client_call_rows", f"""with {ctes('calls', 'items', 'extractions')}, {CALL_ROWS}, o as (select call_id, string_agg(upper(left(replace(label, '_', ' '), 1)) || lower(substr(replace(label, '_', ' '), 2)) || ' (' ||
   case resolution when 'partly_addressed' then 'partly addressed' when 'unresolved' then 'not resolved' else resolution end || '): ' || text, chr(10) order by item_pos) as objections
  from items where collection = 'objections' group by 1)
 select s.*, coalesce(objections, 'None') as objections, coalesce(x.next_action, '') as next_step from shown s left join o on o.call_id = s.call_id left join extractions x on x.call_id = s.call_id""")
def client_call_rows(t):
    """Call rows with objections, how they ended, and the next step."""
    from ..plans import publication as pb
    return pb.call_rows(t.calls, summaries(t), t.items.where("collection = 'objections'"), t.extractions.select("call_id", "next_action"))
