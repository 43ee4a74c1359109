"""Reviews, accuracy, freshness, attempts and budget."""

from pyspark.sql import functions as F

from ..functions.keys import dataset_digest, digest
from ..operators import quality as ql, state
from ..operators.align import word_edits, word_error_rate
from ..operators.small import constants
from ..sources.bindings import ctes
from .base import query, rounded
from .transcripts import second_system

# Held-out calls stand for every call; a template row's artifact changed where the key says so.
TEMPLATE = """template as (select 'C' || o_orderkey as call_id, case when o_orderkey % 4 = 0 then 'new' else 'v1' end as artifact_fingerprint,
   case o_orderkey % 3 when 0 then 'goal' when 1 then 'budget' else 'course' end as field, '' as reviewer, '' as extraction_correct from orders),
 prior as (select 'C' || l_orderkey as call_id, 'v1' as artifact_fingerprint, case l_orderkey % 3 when 0 then 'goal' when 1 then 'budget' else 'course' end as field,
   'reviewer ' || l_suppkey % 3 as reviewer, case l_partkey % 3 when 0 then ' Yes ' when 1 then 'NO' else 'yes' end as extraction_correct, '2026-10-02' as reviewed_at,
   lpad(l_linenumber::varchar, 2, '0') || lpad(l_partkey::varchar, 10, '0') || lpad(l_suppkey::varchar, 9, '0') || lpad((l_quantity::bigint)::varchar, 4, '0')
     || lpad((round(l_extendedprice * 100, 0)::bigint)::varchar, 12, '0') as row_no from lineitem),
 last as (select * from prior qualify row_number() over (partition by call_id, artifact_fingerprint, field order by row_no desc) = 1)"""
KEYS = ["call_id", "artifact_fingerprint", "field"]


def template(t):
    key = F.col("o_orderkey")
    return t.raw("orders").select(F.concat(F.lit("C"), key.cast("string")).alias("call_id"), F.when(key % 4 == 0, "new").otherwise("v1").alias("artifact_fingerprint"),
                                  F.when(key % 3 == 0, "goal").when(key % 3 == 1, "budget").otherwise("course").alias("field"),
                                  F.lit("").alias("reviewer"), F.lit("").alias("extraction_correct"))


def prior(t):
    key, part = F.col("l_orderkey"), F.col("l_partkey")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    row_no = F.concat(pad(F.col("l_linenumber"), 2), pad(part, 10), pad(F.col("l_suppkey"), 9), pad(F.col("l_quantity").cast("bigint"), 4),
                      pad(F.round(F.col("l_extendedprice") * 100, 0).cast("bigint"), 12))
    return t.raw("lineitem").select(
        F.concat(F.lit("C"), key.cast("string")).alias("call_id"), F.lit("v1").alias("artifact_fingerprint"),
        F.when(key % 3 == 0, "goal").when(key % 3 == 1, "budget").otherwise("course").alias("field"),
        F.concat(F.lit("reviewer "), (F.col("l_suppkey") % 3).cast("string")).alias("reviewer"),
        F.when(part % 3 == 0, " Yes ").when(part % 3 == 1, "NO").otherwise("yes").alias("extraction_correct"), F.lit("2026-10-02").alias("reviewed_at"), row_no.alias("row_no"))


@query("review_merge", f"""with {TEMPLATE} select t.call_id, t.artifact_fingerprint, t.field, coalesce(l.reviewer, t.reviewer) as reviewer, l.reviewed_at,
 coalesce(l.extraction_correct, t.extraction_correct) as extraction_correct from template t
 left join last l on l.call_id = t.call_id and l.artifact_fingerprint = t.artifact_fingerprint and l.field = t.field""")
def review_merge(t):
    return ql.merge_reviews(template(t), prior(t), KEYS, "row_no")


@query("superseded_reviews", f"""with {TEMPLATE} select l.* from last l where not exists (select 1 from template t where l.call_id = t.call_id
 and l.artifact_fingerprint = t.artifact_fingerprint and l.field = t.field)""")
def superseded_reviews(t):
    return ql.superseded(template(t), prior(t), KEYS, "row_no")


MARKED = f"""{TEMPLATE}, cur as (select call_id, artifact_fingerprint as now from template),
 marked as (select p.*, case when p.artifact_fingerprint <> now or now is null then 'stale' when row_number() over (partition by p.call_id, p.field,
   p.artifact_fingerprint = now order by row_no) = 1 then 'used' else 'duplicate' end as state from prior p left join cur on cur.call_id = p.call_id)"""


def marked(t):
    current = template(t).select("call_id", F.col("artifact_fingerprint").alias("fingerprint"))
    return ql.fresh_reviews(prior(t), current, ["call_id", "field"], "row_no")


@query("review_freshness", f"with {MARKED} select call_id, field, row_no, state from marked")
def review_freshness(t):
    return marked(t).select("call_id", "field", "row_no", "state")


@query("field_accuracy", f"""with {MARKED} select count(*) filter (state = 'used') as reviewed_fields, count(*) filter (state = 'used') as available_field_rows,
 count(*) filter (state <> 'used') as ignored_rows, round(count(*) filter (state = 'used' and lower(trim(extraction_correct)) = 'yes') / count(*) filter (state = 'used'), 6) as field_accuracy from marked""")
def field_accuracy(t):
    return rounded(ql.field_accuracy(marked(t)))


@query("validation_status", f"""with {ctes('reviews')}, c as (select count(*) filter (reviewer <> '' and reviewed_at is not null and lower(trim(correct)) in ('yes', 'no')) as n,
   count(*) filter (reviewer <> '' and reviewed_at is not null and lower(trim(correct)) = 'yes') as k, count(*) as total from reviews),
 w as (select *, k / n as p, 1.96 * 1.96 / n as z from c)
 select n as audit_reviewed, k as audit_correct, total as audit_sample, round(p, 6) as audit_precision,
  round(greatest(0, (p + z / 2) / (1 + z) - 1.96 * sqrt(p * (1 - p) / n + z / (4 * n)) / (1 + z)), 6) as audit_low,
  round(least(1, (p + z / 2) / (1 + z) + 1.96 * sqrt(p * (1 - p) / n + z / (4 * n)) / (1 + z)), 6) as audit_high, n = total and total > 0 as complete from w""")
def validation_status(t):
    return rounded(ql.validation_status(t.reviews))


@query("audit_sample", f"""with {ctes('calls', 'items', 'lines')}, a as (select i.call_id, item_pos, left(collection, length(collection) - 1) || ' (' || replace(label, '_', ' ') || '): ' || i.text as claim,
   created_on, l.start, l.text as quote from items i join calls c on c.call_id = i.call_id join lines l on l.call_id = i.call_id and l.segment_id = i.segment_id)
 select call_id, item_pos, claim, cast(created_on::date as varchar) as date, printf('%d:%02d', cast(floor(start / 60) as bigint), cast(floor(start) as bigint) % 60) as timestamp, quote,
  sha256('["claim-audit-v1", "' || call_id || '", "' || claim || '"]') as draw_hash from a order by draw_hash, item_pos limit 100""")
def audit_sample(t):
    return ql.audit_sample(t.items, t.calls, t.lines)


@query("qa_sheet", f"""with {TEMPLATE} select call_id, artifact_fingerprint, unnest([{', '.join(f"'{f}'" for f in ql.QA_FIELDS)}]) as field from template""")
def qa_sheet(t):
    return ql.qa_sheet(template(t).select("call_id", F.col("artifact_fingerprint").alias("fingerprint")))


@query("evaluate_references")
def evaluate_references(t):
    """Word error over signed references: turns are references, their degraded copies hypotheses, every ninth is unsigned."""
    rows = t.segments.withColumns({
        "state": F.lit("used"), "reference_text": F.when(F.col("turn") % 7 == 6, "").otherwise(F.col("text")), "reviewed_silence": F.when(F.col("turn") % 7 == 6, "Yes").otherwise(""),
        "reviewer": F.when(F.col("conv_id") % 9 > 0, "Reviewer").otherwise(""), "reviewed_at": F.lit("2026-10-02")})
    scorable = ql.scorable_references(rows).select("call_id", "segment_id", "reference", "silent")
    pairs = scorable.join(second_system(t).select("call_id", "segment_id", F.col("text").alias("hypothesis")), ["call_id", "segment_id"])
    return rounded(word_error_rate(word_edits(pairs)))


# Every turn stands for a call; its words are numbered, so that the best alignment is known: of every thirty, one is dropped, one swapped and one
# added to by the system under review.
REVIEWED = """r as (select conv_id, turn, conv_id || '-' || turn as call_id, len(list_filter(string_split(text, ' '), lambda w: w <> '')) as n, turn % 7 = 6 as silent from conversations),
 held as (select * from r where conv_id % 3 > 0),
 texts as (select *, case when conv_id % 5 = 0 then 'stale' when k = 2 then 'duplicate' else 'used' end as state, conv_id % 7 > 0 and (silent or n > 0) as scored
  from (select *, unnest(case when turn % 4 = 1 then [1, 2] else [1] end) as k from r)),
 seen as (select t.*, (n + 27) // 30 as dropped, (n + 17) // 30 as swapped, (n + 7) // 30 as added from texts t where state = 'used' and scored and conv_id % 3 > 0),
 fields as (select *, case when conv_id % 4 = 0 then 'stale' else 'used' end as state from (select *, unnest(['goal', 'budget']) as field from r))"""


def numbered(n, each):
    """Words 1 .. n, each given by a function of its number, in one text."""
    words = F.transform(F.sequence(F.lit(1), n), each)
    return F.when(n > 0, F.array_join(F.filter(words, lambda w: w != ""), " ")).otherwise("")


def turn_texts(t):
    """What was said in each turn, and what the system under review made of it."""
    n = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    heard = lambda i: F.when(i % 30 == 3, "").when(i % 30 == 13, F.concat(F.lit("z"), i.cast("string"))).when(
        i % 30 == 23, F.concat(F.lit("w"), i.cast("string"), F.lit(" y"), i.cast("string"))).otherwise(F.concat(F.lit("w"), i.cast("string")))
    rows = t.segments.select("conv_id", "turn", F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("call_id"), n.alias("n"))
    return rows.withColumns({"said": numbered(F.col("n"), lambda i: F.concat(F.lit("w"), i.cast("string"))), "text": numbered(F.col("n"), heard), "silent": F.col("turn") % 7 == 6})


def reviewed_turns(t):
    rows = turn_texts(t)
    signed = [F.when(F.col("conv_id") % 7 > 0, "Reviewer").otherwise("").alias("reviewer"), F.lit("2026-10-02").alias("reviewed_at")]
    copies = F.explode(F.when(F.col("turn") % 4 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("row_no")
    texts = rows.select("call_id", F.when(F.col("conv_id") % 5 == 0, "old").otherwise("t1").alias("artifact_fingerprint"), F.when(F.col("silent"), "").otherwise(F.col("said")).alias("reference_text"),
                        F.when(F.col("silent"), "Yes").otherwise("").alias("reviewed_silence"), *signed, copies)
    verdict = F.when(F.col("turn") % 3 == 0, " Yes").when(F.col("turn") % 3 == 1, "no").otherwise("maybe")
    fields = rows.select("call_id", F.when(F.col("conv_id") % 4 == 0, "old").otherwise("e1").alias("artifact_fingerprint"), verdict.alias("extraction_correct"), *signed,
                         F.lit(1).alias("row_no"), F.explode(F.array(F.lit("goal"), F.lit("budget"))).alias("field"))
    holdout = rows.where(F.col("conv_id") % 3 > 0).select("call_id")
    return holdout, rows.select("call_id", F.lit("t1").alias("fingerprint"), "text"), rows.select("call_id", F.lit("e1").alias("fingerprint")), texts, fields


@query("review_evaluation", f"""with {REVIEWED}, w as (select count(*) as reviewed_calls, count(*) filter (silent) as reviewed_silent_calls, coalesce(sum(n) filter (not silent), 0)::bigint as reference_words,
   coalesce(sum(swapped) filter (not silent), 0)::bigint as substitutions, coalesce(sum(dropped) filter (not silent), 0)::bigint as deletions,
   coalesce(sum(case when silent then n - dropped + added else added end), 0)::bigint as insertions from seen),
 f as (select count(*) filter (held and state = 'used' and conv_id % 7 > 0 and turn % 3 < 2) as reviewed_fields, count(*) filter (held and state = 'used') as available_field_rows,
   count(*) filter (not (held and state = 'used')) as ignored_fields, count(*) filter (held and state = 'used' and conv_id % 7 > 0 and turn % 3 = 0) as right_fields
  from (select *, conv_id % 3 > 0 as held from fields))
 select (select count(*) from held) as expected_holdout_calls, reviewed_calls, reviewed_silent_calls, round((substitutions + deletions + insertions) / reference_words, 6) as wer, reference_words,
  substitutions, deletions, insertions, reviewed_fields, available_field_rows,
  ignored_fields + (select count(*) from texts where not (conv_id % 3 > 0 and state = 'used')) as ignored_rows, round(right_fields / reviewed_fields, 6) as field_accuracy from w, f""")
def review_evaluation(t):
    """Held-out calls, freshness, silence, word errors and field verdicts in one result."""
    return rounded(ql.evaluate(*reviewed_turns(t), "row_no"))


@query("word_edits_forced", f"""with {REVIEWED} select call_id, (n - (n + 27) // 30 - (n + 17) // 30)::bigint as hits, ((n + 17) // 30)::bigint as substitutions, ((n + 27) // 30)::bigint as deletions,
 ((n + 7) // 30)::bigint as insertions from r""")
def word_edits_forced(t):
    """Edit counts per turn where every word has a number."""
    return word_edits(turn_texts(t), "said", "text").select("call_id", "hits", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("substitutions", "deletions", "insertions")])


@query("transcription_sheet", f"""with {ctes('calls')} select 'lead ' || lead as lead_alias, call_id, 't1' as artifact_fingerprint, 0 as start_seconds, duration_seconds as end_seconds, '' as reference_text,
 '' as reviewed_silence, '' as reviewer, '' as reviewed_at from calls where source_row % 5 > 0""")
def transcription_sheet(t):
    """Every call with a transcript is held out here; a fifth has none."""
    current = t.calls.where(F.col("source_row") % 5 > 0).select(F.concat(F.lit("lead "), "lead").alias("lead_alias"), "call_id", F.lit("t1").alias("fingerprint"), "duration_seconds")
    return ql.transcription_sheet(current)


# Stored fingerprints: every 10th transcript and every 7th consensus comes from an older method.
CHAIN = """audio as (select 'C' || o_orderkey as call_id, sha256(o_orderkey::varchar) as sha, o_orderkey as k from orders),
 fp as (select *, sha256('["' || sha || '", "asr-v1"]') as t1, sha256('["' || sha256('["' || sha || '", "asr-v1"]') || '", "resolver-v5"]') as c1 from audio),
 stored as (select *, case when k % 6 = 5 then null when k % 10 = 0 then 'old' else t1 end as t, case when k % 11 = 10 then null when k % 7 = 0 then 'old' else c1 end as c,
   sha256('["' || c1 || '", "extract-v3"]') as e1 from fp)"""
FRESH = f"""{CHAIN}, fresh as (select call_id, 'transcript' as stage, case when t is null then 'missing' when t = t1 then 'current' else 'stale' end as state from stored
 union all select call_id, 'consensus', case when c is null then 'missing' when c = c1 and t = t1 then 'current' else 'stale' end from stored
 union all select call_id, 'extraction', case when k % 13 = 0 then 'missing' when c = c1 and t = t1 then 'current' else 'stale' end from stored)"""
VERSIONS = [("transcript", "asr-v1"), ("consensus", "resolver-v5"), ("extraction", "extract-v3")]


def chain(t):
    k = F.col("o_orderkey")
    audio = t.raw("orders").select(F.concat(F.lit("C"), k.cast("string")).alias("call_id"), F.sha2(k.cast("string"), 256).alias("sha256"), k.alias("k"))
    t1 = digest(F.col("sha256"), "asr-v1")
    c1 = digest(t1, "resolver-v5")
    k = F.col("k")
    cells = F.array(F.struct(F.lit("transcript").alias("stage"), F.when(k % 6 != 5, F.when(k % 10 == 0, "old").otherwise(t1)).alias("fingerprint")),
                    F.struct(F.lit("consensus").alias("stage"), F.when(k % 11 != 10, F.when(k % 7 == 0, "old").otherwise(c1)).alias("fingerprint")),
                    F.struct(F.lit("extraction").alias("stage"), F.when(k % 13 != 0, digest(c1, "extract-v3")).alias("fingerprint")))
    return audio, audio.select("call_id", F.inline(cells)).filter(F.col("fingerprint").isNotNull())


@query("artifact_freshness", f"with {FRESH} select * from fresh")
def artifact_freshness(t):
    audio, artifacts = chain(t)
    return state.freshness(audio, artifacts, VERSIONS)


@query("pipeline_status", f"with {FRESH} select stage, state, count(*) as calls from fresh group by 1, 2")
def pipeline_status(t):
    audio, artifacts = chain(t)
    return state.status_counts(state.freshness(audio, artifacts, VERSIONS))


@query("incremental_todo", f"with {CHAIN} select call_id, t1 as fingerprint from stored where t is null or t <> t1")
def incremental_todo(t):
    audio, artifacts = chain(t)
    inputs = audio.select("call_id", digest(F.col("sha256"), "asr-v1").alias("fingerprint"))
    return state.todo(inputs, artifacts.filter(F.col("stage") == "transcript"))


@query("transcript_source", f"""with {CHAIN} select call_id, case when c is not null then c else t end as fingerprint, case when c is not null then 'consensus' when t is not null then 'labelled'
 else 'missing' end as source from stored""")
def transcript_source(t):
    audio, artifacts = chain(t)
    return state.source_of(audio, artifacts.filter(F.col("stage") == "consensus"), artifacts.filter(F.col("stage") == "transcript"))


@query("attempt_history", f"""with {ctes('ledger')} select call_id, stage, count(*) as attempts, count(*) filter (status = 'failed') as failures,
 arg_max(status, strftime(recorded_at, '%Y%m%d%H%M%S%f') || lpad(event_id::varchar, 12, '0')) as last_status, round(sum(external_cost_inr), 6) as cost_inr, count(*) > 1 as retried from ledger group by 1, 2""")
def attempt_history(t):
    return rounded(state.attempts(t.ledger))


CAP = 9000.0
RUNNING = f"running as (select *, sum(final_inr) over (partition by budget_id order by ts, event_id rows unbounded preceding) as committed_inr from budget_events)"


@query("budget_running", f"with {ctes('budget_events')}, {RUNNING} select budget_id, request_id, round(committed_inr, 4) as committed_inr, committed_inr > {CAP} as over_cap from running")
def budget_running(t):
    return rounded(state.budget_running(t.budget_events, CAP).select("budget_id", "request_id", "committed_inr", "over_cap"), 4)


@query("budget_breach", f"""with {ctes('budget_events')}, {RUNNING} select budget_id, request_id, ts from running where committed_inr > {CAP}
 qualify row_number() over (partition by budget_id order by ts, event_id) = 1""")
def budget_breach(t):
    return state.budget_breach(state.budget_running(t.budget_events, CAP))


@query("budget_committed", f"""with {ctes('budget_events')} select budget_id, round(sum(final_inr), 4) as committed_inr, round(sum(case when final_status = 'reserved' then final_inr else 0 end), 4) as in_flight_inr,
 count(*) filter (final_status = 'uncertain_reserve_retained') as uncertain from budget_events group by 1""")
def budget_committed(t):
    return rounded(state.committed(t.budget_events), 4)


def _digest_sql(name, columns, source):
    lanes = ", ".join(f"sum(('0x' || substr(h, {1 + 12 * i}, 12))::bigint)::hugeint" for i in range(5))
    cells = " || ', ' || ".join(f"coalesce('\"' || {c}::varchar || '\"', 'null')" for c in sorted(columns))
    return f"select '{name}' as name, sha256(concat_ws('-', count(*), {lanes})) as sha256 from (select sha256('[' || {cells} || ']') as h from {source})"


@query("dataset_drift", f"""with {ctes('calls', 'leads')}, d as ({_digest_sql('calls', ['call_id', 'lead', 'flag'], 'calls')} union all {_digest_sql('leads', ['lead', 'segment'], 'leads')}),
 m as (select name, case name when 'calls' then sha256 else 'frozen elsewhere' end as frozen from d union all select 'journeys', 'gone')
 select coalesce(d.name, m.name) as name, sha256, frozen from d full join m on m.name = d.name where sha256 is distinct from frozen""")
def dataset_drift(t):
    """Digests of two datasets against a manifest that has one of them right, one wrong, and one that is gone."""
    named = lambda df, name: dataset_digest(df).select(F.lit(name).alias("name"), "sha256")
    digests = named(t.calls.select("call_id", "lead", "flag"), "calls").unionByName(named(t.leads.select("lead", "segment"), "leads"))
    manifest = digests.withColumn("sha256", F.when(F.col("name") == "calls", F.col("sha256")).otherwise("frozen elsewhere")).unionByName(
        constants(t.spark, [("journeys", "gone")], "name string, sha256 string"))
    return state.drift(digests, manifest)


@query("early_coded", """select cast(c_custkey as varchar) as lead, o.first_at as coded_at from customer join (select o_custkey, min(o_orderdate) as first_at from orders group by 1) o on o_custkey = c_custkey
 where c_custkey % 5 = 0 and first_at < '1996-01-01'""")
def early_coded(t):
    """First calls play coding times; every fifth lead is held out."""
    coded = t.calls.groupBy("lead").agg(F.min("created_on").alias("coded_at"))
    return state.coded_early(coded, t.leads.filter(F.col("lead").cast("bigint") % 5 == 0), "1996-01-01")


CELL = lambda c: f"case when regexp_matches(coalesce({c}, ''), '^\\s*[=+\\-@]') then '''' || {c} else coalesce({c}, '') end"


@query("csv_escape", f"""with t as (select event_id, case event_id % 7 when 0 then '=SUM(A1:A2)' when 1 then ' @x' when 2 then '-1+2' when 3 then null else event_type end as cell, props from events)
 select event_id, {CELL('cell')} as cell, {CELL('props')} as props from t""")
def csv_escape(t):
    from ..sources.sinks import safe_table
    k = F.col("event_id") % 7
    cell = F.when(k == 0, "=SUM(A1:A2)").when(k == 1, " @x").when(k == 2, "-1+2").when(k > 3, F.col("event_type"))
    return safe_table(t.raw("events").select("event_id", cell.alias("cell"), "props"))


@query("row_union", """select call_id, lead, null as kind, null::double as value from (select 'C' || o_orderkey as call_id, cast(o_custkey as varchar) as lead from orders)
 union all select 'C' || user_id, null, event_type, value from events""")
def row_union(t):
    """Rows of different shape: the columns are the ordered union, missing cells null."""
    from ..sources.readers import union_rows
    return union_rows([t.calls.select("call_id", "lead"), t.raw("events").select(
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("call_id"), F.col("event_type").alias("kind"), "value")])


@query("transcript_lines", f"""with {ctes('lines')} select call_id, '[' || printf('%02d:%02d', cast(floor(start / 60) as bigint), cast(floor(start) as bigint) % 60) || '] SPEAKER: ' || text as line from lines""")
def transcript_lines(t):
    """Readable transcript lines, as exported per lead."""
    from ..sources.sinks import transcript_line
    return t.lines.select("call_id", transcript_line(F.lit("SPEAKER")).alias("line"))


@query("prompt_lines", """select 'C' || conv_id as call_id, turn, '[C' || conv_id || '#' || turn || '] ' || case role when 'assistant' then 'Agent' when 'user' then 'Person' else 'Speaker' end || ': ' || text as line from conversations""")
def prompt_lines(t):
    """Citable lines with role labels."""
    role = F.when(F.col("role") == "agent", "Agent").when(F.col("role") == "prospect", "Person").otherwise("Speaker")
    return t.segments.select("call_id", "turn", F.concat(F.lit("["), "call_id", F.lit("#"), F.col("segment_id").cast("string"), F.lit("] "), role, F.lit(": "), "text").alias("line"))


@query("transcript_text", """select 'C' || conv_id as call_id, cast(floor((n - 1) / 200) + 1 as bigint) as part, string_agg('[' || turn || '] ' || text, chr(10) order by turn) as transcript
 from (select *, row_number() over (partition by conv_id order by turn) as n from conversations) group by conv_id, 2""")
def transcript_text(t):
    """A call's numbered lines as ordered text, in parts."""
    from ..operators.parts import text_parts
    line = F.concat(F.lit("["), F.col("segment_id").cast("string"), F.lit("] "), "text")
    return text_parts(t.segments, ["call_id"], ["segment_id"], F.floor(F.col("segment_id") / 1024), line, "transcript")
