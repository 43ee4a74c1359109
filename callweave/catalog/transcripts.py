"""Votes, spans, turns, alignment and redaction."""

from pyspark.sql import functions as F

from ..operators import align, consensus as cs, redact
from ..sources.bindings import ctes
from .base import ORACLE, query, rounded

COMPACT = lambda s: f"regexp_replace(lower({s}), '[\\s.:]', '', 'g')"
VOTED = f"""voted as (select *, case when {COMPACT('whisper')} = {COMPACT('gemini')} and {COMPACT('whisper')} = {COMPACT('sarvam')} then 'agreed'
   when {COMPACT('whisper')} = {COMPACT('gemini')} or {COMPACT('whisper')} = {COMPACT('sarvam')} then 'majority_whisper'
   when {COMPACT('gemini')} = {COMPACT('sarvam')} then 'majority_gemini_sarvam' else 'disputed' end as outcome from votes),
 placed as (select *, row_number() over (partition by call_id order by segment_pos) as position from voted),
 isl as (select *, position - row_number() over (partition by call_id order by position) as g from placed where outcome = 'disputed'),
 spanned as (select *, dense_rank() over (partition by call_id order by g) - 1 as span_id from isl)"""


def voted(t):
    return cs.vote(t.votes)


def spans(t, placed=None):
    return cs.disputed_segments(placed or cs.place(voted(t)))


@query("vote_outcomes", f"with {ctes('votes')}, {VOTED} select call_id, outcome, count(*) as segments from voted group by 1, 2")
def vote_outcomes(t):
    return cs.outcome_counts(voted(t))


@query("disputed_spans", f"""with {ctes('votes')}, {VOTED} select call_id, span_id, 1::bigint as part, min(position) as first_position, max(position) as last_position, count(*) as segments,
 {', '.join(f"string_agg({s}, ' ' order by position) as {s}" for s in cs.SYSTEMS)} from spanned group by call_id, span_id""")
def disputed_spans(t):
    return cs.disputed_spans(spans(t))


ORDERED = """(select list(s order by sha256('["' || call_id || '", ' || span_id || ', "' || s || '", "order"]')) from (values ('whisper'), ('gemini'), ('sarvam')) v(s))"""
DECIDED = f"""sp as (select call_id, span_id, min(position) as position, count(*) as merged, {', '.join(f"string_agg({s}, ' ' order by position) as {s}" for s in cs.SYSTEMS)} from spanned group by 1, 2),
 lab as (select call_id, span_id, arg_min(speaker, -n * 1000000 + f) as speaker from (select call_id, span_id, speaker, count(*) as n, min(position) as f from spanned where speaker is not null group by 1, 2, 3) group by 1, 2),
 dec as (select *, case (position + merged) % 5 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'combined' else 'neither' end as choice,
   case (position + merged) % 5 when 3 then 'both ' || merged when 4 then '' else null end as dtext, merged % 2 = 0 as unclear from sp),
 sysd as (select d.*, {ORDERED.replace('call_id', 'd.call_id').replace('span_id', 'd.span_id')} as ord from dec d),
 pickd as (select *, case choice when 'A' then ord[1] when 'B' then ord[2] when 'C' then ord[3] end as sys from sysd),
 built as (select call_id, position, trim(case when outcome = 'majority_gemini_sarvam' then gemini else whisper end) as text, outcome as source, false as unclear, 1::bigint as merged, speaker
   from placed where outcome <> 'disputed'
  union all select p.call_id, position, trim(case sys when 'whisper' then whisper when 'gemini' then gemini when 'sarvam' then sarvam else dtext end),
   'resolved_' || coalesce(sys, choice), unclear, merged, l.speaker from pickd p left join lab l on l.call_id = p.call_id and l.span_id = p.span_id)"""


def decisions(spanned):
    """Deterministic decisions per span stand in for the resolver's table."""
    s = spanned.groupBy("call_id", "span_id").agg(F.min("position").alias("p"), F.count(F.lit(1)).alias("m"))
    k = (F.col("p") + F.col("m")) % 5
    choice = F.when(k == 0, "A").when(k == 1, "B").when(k == 2, "C").when(k == 3, "combined").otherwise("neither")
    text = F.when(k == 3, F.concat(F.lit("both "), F.col("m").cast("string"))).when(k == 4, "")
    return s.select("call_id", "span_id", choice.alias("choice"), text.alias("text"), (F.col("m") % 2 == 0).alias("unclear"))


def built(t):
    roles = t.votes.filter(F.col("speaker").isin("spk:0", "spk:1")).select("call_id", "speaker").distinct().withColumn(
        "role", F.when(F.col("speaker") == "spk:0", "agent").otherwise("prospect"))
    placed = cs.place(voted(t))
    spanned = spans(t, placed)
    return cs.build(placed, spanned, decisions(spanned), roles)


@query("consensus_build", f"""with {ctes('votes')}, {VOTED}, {DECIDED} select call_id, position, text, source, unclear, merged, speaker,
  case speaker when 'spk:0' then 'agent' when 'spk:1' then 'prospect' else 'unknown' end as role, coalesce(text, '') = '' as dropped from built""")
def consensus_build(t):
    return built(t).select("call_id", "position", "text", "source", "unclear", "merged", "speaker", "role", "dropped")


def timed_votes(t):
    """Votes with times: a segment lasts until 7 seconds after its start."""
    return cs.place(voted(t).withColumns({"start": F.col("start_at") * 1.5, "end": F.col("start_at") * 1.5 + 7}))


@query("span_frames", f"""with {ctes('votes')}, {VOTED} select call_id, span_id, 1::bigint as part, (arg_min(start_at, position) * 1.5)::double as start, (arg_max(start_at, position) * 1.5 + 7)::double as "end",
 string_agg(segment_pos, ',' order by position) as merged_ids from spanned group by 1, 2""")
def span_frames(t):
    """When each disputed span starts and ends, and its segments."""
    rows = cs.span_frames(spans(t, timed_votes(t)))
    return rows.select("call_id", "span_id", "part", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), F.array_join("merged_ids", ",").alias("merged_ids"))


@query("consensus_frames", f"""with {ctes('votes')}, {VOTED}, {DECIDED}, fr as (select call_id, min(position) as position, (arg_min(start_at, position) * 1.5)::double as start, (arg_max(start_at, position) * 1.5 + 7)::double as "end",
   string_agg(segment_pos, ',' order by position) as merged_ids from spanned group by call_id, span_id)
 select b.call_id, b.position, b.text, b.source, coalesce(fr.start, (p.start_at * 1.5)::double) as start, coalesce(fr."end", (p.start_at * 1.5 + 7)::double) as "end", coalesce(fr.merged_ids, p.segment_pos) as merged_ids
 from built b join placed p on p.call_id = b.call_id and p.position = b.position left join fr on b.source like 'resolved_%' and fr.call_id = b.call_id and fr.position = b.position""")
def consensus_frames(t):
    """The consensus with times and merged segments."""
    roles = t.votes.filter(F.col("speaker").isin("spk:0", "spk:1")).select("call_id", "speaker").distinct().withColumn(
        "role", F.when(F.col("speaker") == "spk:0", "agent").otherwise("prospect"))
    placed = timed_votes(t)
    spanned = spans(t, placed)
    rows = cs.framed(cs.build(placed, spanned, decisions(spanned), roles), placed, spanned)
    return rows.select("call_id", "position", "text", "source", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), F.array_join("merged_ids", ",").alias("merged_ids"))


@query("decision_counts", f"with {ctes('votes')}, {VOTED}, {DECIDED} select source, count(*) as segments from built where coalesce(text, '') <> '' group by 1")
def decision_counts(t):
    return built(t).filter(~F.col("dropped")).groupBy("source").agg(F.count(F.lit(1)).alias("segments"))


@query("span_candidates", f"""with {ctes('votes')}, {VOTED}, d as (select distinct call_id, span_id from spanned),
  o as (select d.*, {ORDERED.replace('call_id', 'd.call_id').replace('span_id', 'd.span_id')} as ord from d) select call_id, span_id, ord[1] || ',' || ord[2] || ',' || ord[3] as candidates from o""")
def span_candidates(t):
    return spans(t).select("call_id", "span_id").distinct().select(
        "call_id", "span_id", F.array_join(cs.candidate_order(F.col("call_id"), F.col("span_id")), ",").alias("candidates"))


@query("missing_decisions", f"with {ctes('votes')}, {VOTED}, {DECIDED} select call_id, span_id from sp where merged > 1")
def missing_decisions(t):
    """Decisions for spans of one segment only: the longer spans must be reported."""
    spanned = spans(t)
    single = spanned.groupBy("call_id", "span_id").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") == 1)
    return cs.missing_decisions(spanned, decisions(spanned).join(single, ["call_id", "span_id"], "left_semi"))


@query("segment_speakers", f"""with {ctes('votes')}, n as (select call_id, start_at, speaker, count(*) as n, min(segment_pos) as f from votes where speaker is not null group by 1, 2, 3)
 select call_id, start_at % 4 as start_group, speaker from (select call_id, start_at % 4 as start_at, speaker, sum(n) as n, min(f) as f from n group by 1, 2, 3)
 qualify row_number() over (partition by call_id, start_at order by n desc, f) = 1""")
def segment_speakers(t):
    rows = t.votes.withColumn("start_group", F.col("start_at") % 4)
    return cs.majority_label(rows, ["call_id", "start_group"], "speaker", "segment_pos")


@query("turn_times", """with turns as (select 'C' || conv_id as call_id, turn, case when turn % 3 = 2 then null when turn % 5 = 4 then 1.0 else length(text) / 10.0 + turn * 5 end::double as heard_at from conversations),
 m as (select *, greatest(coalesce(max(heard_at) over (partition by call_id order by turn rows unbounded preceding), 0), 0) as start from turns)
 select call_id, turn, start, coalesce(heard_at >= start, false) as timed, lead(start) over (partition by call_id order by turn) as "end" from m""")
def turn_times(t):
    turns = t.raw("conversations").select(F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("call_id"), "turn", F.expr(
        "cast(case when turn % 3 = 2 then null when turn % 5 = 4 then 1.0 else length(text) / 10.0 + turn * 5 end as double)").alias("heard_at"))
    return cs.turn_times(turns).select("call_id", "turn", "start", "timed", "end")


@query("piece_starts", f"""with {ctes('calls')} select call_id, unnest(generate_series(0, 570 * cast(greatest(0, ceil((duration_seconds * 5 - 600) / 570.0)) as bigint), 570)) as start_second from calls""")
def piece_starts(t):
    """Durations times five, so that most calls need several pieces."""
    return cs.piece_starts(t.calls.withColumn("duration_seconds", F.col("duration_seconds") * 5))


LABELLED = """labelled as (select 'T' || conv_id || '-' || turn as call_id, 'intro' || chr(10) || case when turn % 2 = 0 then 'Agent: ' else '**Customer:** ' end || text || chr(10)
  || case when turn % 3 = 0 then ' still talking ' || chr(10) || chr(10) else '' end || 'Customer: ok' || case when turn % 4 = 0 then chr(13) || chr(10) || 'Agent:' else '' end as text from conversations)"""


@query("parse_turns", f"""with {LABELLED}, l as (select call_id, unnest(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10))) as line,
   generate_subscripts(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)), 1) as i from labelled),
 m as (select *, regexp_matches(line, '^\\s*\\**(Agent|Customer)\\**\\s*:') as lab from l),
 g as (select *, sum(case when lab then 1 else 0 end) over (partition by call_id order by i rows unbounded preceding) as n from m),
 b as (select call_id, n, max(case when lab then regexp_extract(line, '^\\s*\\**(Agent|Customer)', 1) end) as who,
   array_to_string(list_filter(list(case when lab then trim(regexp_replace(line, '^\\s*\\**(Agent|Customer)\\**\\s*:\\s*\\**\\s*', '')) else nullif(trim(line), '') end order by i), lambda x: x is not null), ' ') as text
  from g where n > 0 group by 1, 2)
 select call_id, row_number() over (partition by call_id order by n)::int as turn, case who when 'Agent' then 'agent' else 'prospect' end as role, text from b where text <> ''""")
def parse_turns(t):
    return cs.parse_turns(labelled(t))


def labelled(t):
    return t.raw("conversations").select(F.expr("'T' || conv_id || '-' || turn").alias("call_id"), F.expr(
        """'intro\\n' || case when turn % 2 = 0 then 'Agent: ' else '**Customer:** ' end || text || '\\n'
        || case when turn % 3 = 0 then ' still talking \\n\\n' else '' end || 'Customer: ok' || case when turn % 4 = 0 then '\\r\\nAgent:' else '' end""").alias("text"))


@query("parse_turns_lateral", ORACLE["parse_turns"])
def parse_turns_lateral(t):
    """The table function over the same texts."""
    cs.register_parse_turns(t.spark)
    return t.spark.sql("select l.call_id, x.turn, x.role, x.text from {texts} l, lateral parse_turns(l.text) x", texts=labelled(t))


@query("provider_turns", """with o as (select doc_id, to_json({'transcript': case when doc_id % 3 = 0 then null else lang end, 'diarized_transcript': {'entries': [
   {'speaker_id': '0', 'transcript': ' ' || text || ' ', 'start_time_seconds': 0.0, 'end_time_seconds': 1.5}, {'speaker_id': '1', 'transcript': '  ', 'start_time_seconds': 2.0, 'end_time_seconds': 3.0},
   {'speaker_id': '1', 'transcript': source, 'start_time_seconds': 3.0, 'end_time_seconds': 4.0}]}}) as body from documents)
 select d.doc_id, 'sarvam:0=' || trim(text) || '|sarvam:1=' || source as turns, case when d.doc_id % 3 = 0 then trim(text) || ' ' || source else lang end as text from documents d where trim(text) <> ''
 union all select d.doc_id, 'sarvam:1=' || source, case when d.doc_id % 3 = 0 then source else lang end from documents d where trim(text) = ''""")
def provider_turns(t):
    entry = lambda who, said, a, b: F.struct(F.lit(who).alias("speaker_id"), said.alias("transcript"), F.lit(a).alias("start_time_seconds"), F.lit(b).alias("end_time_seconds"))
    body = F.to_json(F.struct(F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("transcript"), F.struct(F.array(
        entry("0", F.concat(F.lit(" "), F.col("text"), F.lit(" ")), 0.0, 1.5), entry("1", F.lit("  "), 2.0, 3.0),
        entry("1", F.col("source"), 3.0, 4.0)).alias("entries")).alias("diarized_transcript")))
    rows = cs.provider_turns(t.raw("documents").select("doc_id", body.alias("body")))
    return rows.select("doc_id", F.array_join(F.transform("turns", lambda x: F.concat(x["speaker"], F.lit("="), x["text"])), "|").alias("turns"), "text")


@query("speaker_samples", """select 'C' || conv_id as call_id, role as speaker, row_number() over (partition by conv_id, role order by turn)::int as sample, left(text, 140) as text
 from conversations qualify sample <= 3""")
def speaker_samples(t):
    turns = t.raw("conversations").select(F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("call_id"), F.col("role").alias("speaker"), "turn", "text")
    return cs.speaker_samples(turns)


@query("asr_flags", f"""with {ctes('calls', 'items')}, s as (select call_id, count(*) filter (trim(coalesce(response, '')) <> '') as spoken,
   bool_or(trim(coalesce(response, '')) <> '' and (-segment_id / 2.0 < -1 or segment_id * 0.9 > 2.4)) as doubtful from items group by 1)
 select c.call_id, concat_ws(',', case when abs(duration_seconds + source_row % 40 - duration_seconds) > greatest(10, duration_seconds * 0.1) then 'audio_duration_differs_from_crm' end,
   case when doubtful then 'asr_segment_needs_review' end, case when coalesce(spoken, 0) = 0 then 'no_speech_transcribed' end) as flags_raw, 0 as x from calls c left join s on s.call_id = c.call_id""".replace(
       ", 0 as x from", " from").replace("select c.call_id, concat_ws(',', case when abs", "select c.call_id, array_to_string(list_sort(string_split(concat_ws(',', case when abs").replace(
       "then 'no_speech_transcribed' end) as flags_raw", "then 'no_speech_transcribed' end), ',')), ',') as flags"))
def asr_flags(t):
    """Item columns stand in for the recogniser's confidence values."""
    segments = t.items.select("call_id", F.col("response").alias("text"), (-F.col("segment_id") / 2).alias("avg_logprob"), (F.col("segment_id") * 0.9).alias("compression_ratio"))
    transcripts = t.calls.select("call_id", "duration_seconds", (F.col("duration_seconds") + F.col("source_row") % 40).alias("audio_seconds"))
    return cs.asr_flags(transcripts, segments).withColumn("flags", F.array_join("flags", ","))


def second_system(t, every=7):
    """A disagreeing transcript: every n-th word of each turn is missing."""
    words = F.filter(F.split("text", r"\s+"), lambda w, i: (i + 1) % every != 0)
    return t.segments.withColumn("text", F.array_join(words, " "))


def owners(t):
    return align.word_owners(align.call_words(t.segments), align.call_words(second_system(t)))


@query("align_transcripts")
def align_transcripts(t):
    rows = align.segment_agreement(t.segments, owners(t))
    return rounded(rows.select("call_id", "segment_id", "matched_words", "agreement", "char_agreement"))


@query("transcript_agreement")
def transcript_agreement(t):
    return rounded(align.call_agreement(owners(t), t.segments.select("call_id")))


# Every word has a name of its own, so the alignment is known: of every thirty words of a turn one is dropped, one swapped, one added to.
NAMED = """n as (select 'C' || conv_id as call_id, turn as segment_id, len(list_filter(string_split(text, ' '), lambda w: w <> '')) as n from conversations),
 parts as (select *, (n + 27) // 30 as dropped, (n + 17) // 30 as swapped, (n + 7) // 30 as added from n)"""


def named_words(t):
    """The two systems' transcripts as segments: what was said, and the other's version of it."""
    n = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    name = lambda letter, i: F.concat(F.lit(letter), F.col("segment_id").cast("string"), F.lit("n"), i.cast("string"))
    heard = lambda i: F.when(i % 30 == 3, "").when(i % 30 == 13, name("z", i)).when(i % 30 == 23, F.concat(name("w", i), F.lit(" "), name("y", i))).otherwise(name("w", i))
    text = lambda each: F.when(F.col("n") > 0, F.array_join(F.filter(F.transform(F.sequence(F.lit(1), F.col("n")), each), lambda w: w != ""), " ")).otherwise("")
    rows = t.segments.withColumn("n", n)
    return rows.withColumn("text", text(lambda i: name("w", i))), rows.withColumn("text", text(heard))


@query("transcript_agreement_named", f"""with {NAMED}, a as (select call_id, sum(n) as b, sum(n - dropped + added) as o, sum(n - dropped - swapped) as hits from parts group by 1)
 select call_id, round(case when greatest(b, o) = 0 then 1 else hits / greatest(b, o) end, 6) as agreement from a""")
def transcript_agreement_named(t):
    """Agreement per call where the alignment is known; calls without words agree."""
    said, heard = named_words(t)
    return rounded(align.call_agreement(align.word_owners(align.call_words(said), align.call_words(heard)), t.segments.select("call_id")))


@query("aligned_words_named", f"with {NAMED} select call_id, segment_id, cast(n - dropped - swapped as bigint) as matched_words from parts where n > 0")
def aligned_words_named(t):
    """Words of each segment that the other system has as well."""
    said, heard = named_words(t)
    own = align.word_owners(align.call_words(said), align.call_words(heard))
    return align.segment_agreement(said, own).where("base_words > 0").select("call_id", "segment_id", F.col("matched_words").cast("bigint").alias("matched_words"))


@query("aligned_speakers")
def aligned_speakers(t):
    turns = second_system(t).select("call_id", F.col("segment_id").alias("turn"), F.col("role").alias("speaker"))
    return align.segment_speakers(owners(t), turns)


@query("similar_turns")
def similar_turns(t):
    """Vote between each turn and its two degraded copies: long texts, so the ratio decides."""
    a = t.segments.select("call_id", F.col("segment_id").alias("segment_pos"), F.col("text").alias("whisper"))
    b = second_system(t, 7).select("call_id", F.col("segment_id").alias("segment_pos"), F.col("text").alias("gemini"))
    c = second_system(t, 25).select("call_id", F.col("segment_id").alias("segment_pos"), F.col("text").alias("sarvam"))
    return cs.vote(a.join(b, ["call_id", "segment_pos"]).join(c, ["call_id", "segment_pos"])).select("call_id", "segment_pos", "outcome")


@query("timed_turns")
def timed_turns(t):
    turns = t.segments.select("call_id", F.col("segment_id").alias("turn"), "role", "text")
    passages = second_system(t).select("call_id", "segment_id", "text", F.col("start").cast("double").alias("start"))
    return align.timed_segments(turns, passages).select("call_id", "turn", "role", "start", "timed", "end")


@query("stitch_pieces")
def stitch_pieces(t):
    """Each conversation in overlapping pieces of two turns: piece n holds turns n and n + 1."""
    rows = t.segments.select("call_id", F.explode(F.array(F.col("segment_id"), F.col("segment_id") - 1)).alias("piece"), F.col("segment_id").alias("turn"), "role", "text")
    return align.stitch(rows.filter(F.col("piece") >= 0))


@query("stitch_pieces_named", f"""with {NAMED}, p as (select call_id, unnest([segment_id, segment_id - 1]) as piece, segment_id as turn, n from n),
 k as (select p.*, piece > 0 and (coalesce(o.n, 0) < 6 or o.n > 344) as loose from p left join n o on o.call_id = p.call_id and o.segment_id = p.piece where piece >= 0 and p.n > 0),
 left_ as (select *, case when piece > 0 and not loose and turn = piece then least(n, 200) else 0 end as cut from k)
 select call_id, piece::bigint as piece, turn::bigint as turn, array_to_string(list_transform(range(cut + 1, n + 1), lambda i: 'w' || turn || 'n' || i), ' ') as text,
  case when loose and turn = min(turn) over (partition by call_id, piece) then 'join_' || piece || '_unmatched' end as flag from left_ where cut < n""")
def stitch_pieces_named(t):
    """Pieces of two turns each, where every word has a name: a repeated turn is cut where six words and more of the last 150 stand among the first 200."""
    said, _ = named_words(t)
    rows = said.select("call_id", F.explode(F.array(F.col("segment_id"), F.col("segment_id") - 1)).alias("piece"), F.col("segment_id").alias("turn"), "role", "text")
    return align.stitch(rows.filter(F.col("piece") >= 0)).select("call_id", "piece", "turn", "text", "flag")


@query("timed_turns_named", f"""with {NAMED}, h as (select call_id, segment_id as turn, case when n - dropped - swapped > 0 then segment_id * 20.0 end::double as heard_at from parts),
 m as (select *, greatest(coalesce(max(heard_at) over (partition by call_id order by turn rows unbounded preceding), 0), 0) as start from h)
 select call_id, turn::bigint as turn, start, coalesce(heard_at >= start, false) as timed, lead(start) over (partition by call_id order by turn) as "end" from m""")
def timed_turns_named(t):
    """Turns timed by the other system's passages, where every word has a name."""
    said, heard = named_words(t)
    turns = said.select("call_id", F.col("segment_id").alias("turn"), "role", "text")
    rows = align.timed_segments(turns, heard.select("call_id", "segment_id", "text", F.col("start").cast("double").alias("start")))
    return rows.select("call_id", F.col("turn").cast("bigint").alias("turn"), "start", "timed", "end")


@query("word_error_rate")
def word_error_rate(t):
    pairs = t.segments.select("call_id", "segment_id", F.col("text").alias("reference")).join(
        second_system(t).select("call_id", "segment_id", F.col("text").alias("hypothesis")), ["call_id", "segment_id"])
    return rounded(align.word_error_rate(align.word_edits(pairs)))


@query("redact_names", f"""with {ctes('calls', 'leads')}, low as (select distinct unnest(regexp_extract_all(regexp_replace(text, '[^\\p{{L}}\\p{{N}}_]+', '  ', 'g'), '(^| )([a-z]{{3,}})( |$)', 2)) as word from documents),
 n as (select c.call_id, c.lead, salesperson, conversation_type, 'the lead ' || nation as named,
   case when 'agent' in (select word from low) then 'agent' else 'the counsellor' end as staff from calls c join leads l on l.lead = c.lead)
 select call_id as text_id, lead, 'They told the ' || staff || ', ' || case when staff = 'agent' then 'Agent' else staff end || replace(salesperson, 'Agent', '') || ', that ' || named || ' called back; their lead'
  || case when conversation_type like '%\\_%' escape '\\' then ' ' || upper(left(conversation_type, 1)) || substr(conversation_type, 2) else '' end || ', an engineer, thanked them.' as text from n""")
def redact_names(t):
    """Customer segment words play lead names, agents staff names, over generated summaries of every call."""
    leads = t.leads.select("lead", F.concat("segment", F.lit(" "), "nation").alias("lead_name"))
    calls = t.calls.join(leads, "lead").select(F.col("call_id").alias("text_id"), "lead", F.concat(
        F.lit("She told the agent, "), "salesperson", F.lit(", that "), "lead_name", F.lit(" called back; his prospect "), F.initcap("conversation_type"),
        F.lit(", an engineer, thanked her.")).alias("text"))
    staff, names = redact.name_words(t.calls, leads, t.texts)
    return redact.redact(calls, redact.own_words(leads), staff, names)


@query("possible_names", """with cap as (select distinct unnest(regexp_extract_all(regexp_replace(text, '[^\\p{L}\\p{N}_]+', '  ', 'g'), '(^| )([A-Z][a-z]{2,})( |$)', 2)) as word from documents),
 low as (select distinct unnest(regexp_extract_all(regexp_replace(text, '[^\\p{L}\\p{N}_]+', '  ', 'g'), '(^| )([a-z]{3,})( |$)', 2)) as word from documents)
 select word from cap where lower(word) not in (select word from low) and lower(word) not in ('january', 'february', 'march', 'april', 'may', 'june', 'july', 'august', 'september',
  'october', 'november', 'december', 'jan', 'feb', 'mar', 'apr', 'jun', 'jul', 'aug', 'sep', 'sept', 'oct', 'nov', 'dec', 'monday', 'tuesday', 'wednesday', 'thursday', 'friday', 'saturday', 'sunday')""")
def possible_names(t):
    return redact.possible_names(t.texts)


@query("name_words", """with low as (select distinct unnest(regexp_extract_all(regexp_replace(text, '[^\\p{L}\\p{N}_]+', '  ', 'g'), '(^| )([a-z]{3,})( |$)', 2)) as word from documents),
 staff as (select distinct unnest(regexp_extract_all(lower(s_name), '[a-z]{3,}')) as word from supplier), own as (select distinct unnest(regexp_extract_all(lower(n_name), '[a-z]{3,}')) as word from nation
   join customer on c_nationkey = n_nationkey)
 select 'staff' as kind, word from staff where word <> 'data' and word not in (select word from low) union all select 'lead', word from own where word <> 'data' and word not in (select word from low)""")
def name_words(t):
    staff, names = redact.name_words(t.raw("supplier").select(F.col("s_name").alias("salesperson")), t.leads.select(F.col("nation").alias("lead_name")), t.texts)
    return staff.select(F.lit("staff").alias("kind"), "word").unionByName(names.select(F.lit("lead").alias("kind"), "word"))
