"""Voting over several transcripts of a call, disputed spans, and turns from text and provider output.

Segments are long: (call_id, segment_pos or segment_id, one text column per system)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.keys import digest
from ..session import keep
from .ranking import by_size, islands, join_back, neighbour, positions, positions_by_size, prefix_scan

# ---- fixed values ----
SYSTEMS = ("whisper", "gemini", "sarvam")
SHORT_TEXT = 12
THRESHOLD = 0.9
PIECE_SECONDS, OVERLAP_SECONDS = 600, 30
LINE_BREAKS = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
TURN_LABEL = r"\s*\**(Agent|Customer)\**\s*:\s*\**\s*"
# ---- end of fixed values ----


def outcome(wg, ws, gs):
    """Two of three decide; the first system's words win when it is in the majority."""
    return (F.when(wg & ws, "agreed").when(wg | ws, "majority_whisper").when(gs, "majority_gemini_sarvam").otherwise("disputed"))


def vote(rows):
    """Adds the outcome. Rows are parted by the texts' raw lengths, a cheap test Spark can push to the scan: where all
    three are surely short, equality decides natively; only the other rows go through the ratio job in Python."""
    from .align import vote_ratios

    rows = rows.na.fill("", list(SYSTEMS))
    longest = F.greatest(*[F.length(F.replace(F.col(s), F.lit("ß"), F.lit("ss"))) for s in SYSTEMS])
    plain = {"__" + s: tx.compact(F.col(s)) for s in SYSTEMS}
    w, g, s = (F.col("__" + x) for x in SYSTEMS)
    short = rows.filter(longest < SHORT_TEXT).withColumns(plain).withColumn("outcome", outcome(w == g, w == s, g == s))
    long = vote_ratios(rows.filter(longest >= SHORT_TEXT).withColumns(plain), "__whisper", "__gemini", "__sarvam", SHORT_TEXT, THRESHOLD)
    long = long.withColumn("outcome", outcome(F.col("wg"), F.col("ws"), F.col("gs"))).drop("wg", "ws", "gs")
    return short.unionByName(long).drop(*plain)


def outcome_counts(voted):
    return voted.groupBy("call_id", "outcome").agg(F.count(F.lit(1)).alias("segments"))


def place(voted, order="segment_pos", digits=9):
    """Position of each segment in its call. Kept: votes are costly and spans, decisions and texts all start here."""
    return keep(positions_by_size(voted, ["call_id"], [order], F.left(F.col(order).cast("string"), F.lit(digits)), "position"), "placed")


def disputed_segments(placed):
    """Disputed segments with the number of their span (a run of consecutive disputed segments). Kept: heads, texts, speakers and decisions of the
    spans are all taken from them."""
    return keep(islands(placed, ["call_id"], "position", F.col("outcome") == "disputed", F.floor(F.col("position") / 1024), "span_id"), "spans")


def in_parts(segments, per_span):
    """Adds the number of segments of each one's span, its part and the number of parts: a span longer than `per_span` segments has several."""
    span = ["call_id", "span_id"]
    facts = {"__first": F.min("position"), "__last": F.max("position"), "merged": F.count(F.lit(1))}
    plain = lambda rows: rows.withColumns({name: fact.over(Window.partitionBy(*span)) for name, fact in facts.items()})
    cut = lambda rows: join_back(rows, rows.groupBy(*span).agg(*[fact.alias(name) for name, fact in facts.items()]), span)
    rows = by_size(segments.filter(F.col("call_id").isNotNull() & F.col("span_id").isNotNull()), span, plain, cut)
    part = lambda position: F.floor((F.col(position) - F.col("__first")) / per_span) + 1
    return rows.withColumns({"part": part("position"), "parts": part("__last")}).drop("__first", "__last")


def disputed_spans(segments, per_span=2000):
    """One row per span: first and last position, size, and each system's words joined in order. A span longer than
    `per_span` segments continues in further parts, so the joined text stays bounded."""
    return _span_texts(segments, per_span).drop("merged", "parts")


def _span_texts(segments, per_span=2000):
    """The same with `merged`, the segments of the whole span, and the number of its parts."""
    rows = in_parts(segments, per_span)
    joined = [F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("position", F.col(s).alias("t")))), lambda x: F.coalesce(x["t"], F.lit("")) != ""),
                                       lambda x: x["t"]), " ").alias(s) for s in SYSTEMS]
    return rows.groupBy("call_id", "span_id", "part").agg(F.min("position").alias("first_position"), F.max("position").alias("last_position"),
                                                         F.count(F.lit(1)).alias("segments"), *joined, F.min("merged").alias("merged"),
                                                         F.min("parts").alias("parts"))


def span_frames(segments, key="segment_pos", per_span=2000):
    """One row per span and part: from when to when it lasts and which segments it merges, in order. `segments` has start and end."""
    rows = in_parts(segments, per_span)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("position", F.col(key).alias("id")))), lambda x: x["id"])
    return rows.groupBy("call_id", "span_id", "part").agg(F.min("position").alias("first_position"), F.min_by("start", "position").alias("start"),
                                                         F.max_by("end", "position").alias("end"), ids.alias("merged_ids"))


def framed(built, placed, spans, key="segment_pos"):
    """Consensus rows with start, end and the segments each stands for: one of its own for an agreed row, those of its span for a decided one. Copied
    words of several parts have each part's own; a written decision stands once, for the segments of all parts."""
    own = placed.select("call_id", "position", "start", "end", F.array(F.col(key)).alias("merged_ids"), F.lit(0).alias("__kind"))
    frames = span_frames(spans, key).groupBy("call_id", "span_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("first_position").alias("position"), "start", "end", "merged_ids", F.lit(1).alias("__kind")))).alias("x"))
    whole = F.struct(F.col("x")[0]["position"].alias("position"), F.col("x")[0]["start"].alias("start"), F.element_at("x", -1)["end"].alias("end"),
                     F.flatten("x.merged_ids").alias("merged_ids"), F.lit(2).alias("__kind"))
    joint = frames.select("call_id", F.inline(F.when(F.size("x") > 1, F.concat("x", F.array(whole))).otherwise(F.col("x"))))
    kind = F.when(F.col("source").startswith("resolved_"), F.when(F.col("whole"), 2).otherwise(1)).otherwise(0)
    return built.withColumn("__kind", kind).join(own.unionByName(joint), ["call_id", "position", "__kind"]).drop("__kind", "whole")


def candidate_order(call_id, span_id):
    """The three systems behind letters A, B and C, shuffled by digest per span."""
    tagged = F.array(*[F.struct(digest(call_id, ("number", span_id), s, "order").alias("h"), F.lit(s).alias("s")) for s in SYSTEMS])
    return F.transform(F.array_sort(tagged), lambda x: x["s"])


def majority_label(rows, keys, label, order):
    """Most frequent label per key; ties go to the one seen first; null labels do not vote."""
    votes = rows.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    best = F.min_by(label, F.struct((-F.col("n")).alias("n"), "first"))
    return votes.groupBy(*keys).agg(best.alias(label))


def build(placed, spans, decisions, roles):
    """Majority text per agreed segment and one row per disputed span carrying its decision.

    `placed` has voted segments with position and speaker; `spans` the disputed segments with span_id; `decisions` has
    call_id, span_id, choice, text, unclear; `roles` has call_id, speaker, role. Rows without text are flagged dropped, written decisions that stand for
    several parts of a span `whole`."""
    agreed = placed.filter(F.col("outcome") != "disputed").select(
        "call_id", "position", F.trim(F.when(F.col("outcome") == "majority_gemini_sarvam", F.col("gemini")).otherwise(F.col("whisper"))).alias("text"),
        F.col("outcome").alias("source"), F.lit(False).alias("unclear"), F.lit(1).cast("bigint").alias("merged"), "speaker", F.lit(False).alias("whole"))
    labels = majority_label(spans, ["call_id", "span_id"], "speaker", "position")
    letter = F.col("choice").isin("A", "B", "C")
    # The system behind a letter is digested before the join, once a decision: behind it, every use of the column would digest anew.
    behind = F.when(letter, F.get(candidate_order(F.col("call_id"), F.col("span_id")), F.instr(F.lit("ABC"), F.col("choice")) - 1))
    decided = decisions.withColumn("__system", behind)
    rows = _span_texts(spans).drop("segments").join(decided, ["call_id", "span_id"]).join(labels, ["call_id", "span_id"], "left")
    system = F.col("__system")
    copied = F.when(system == "whisper", F.col("whisper")).when(system == "gemini", F.col("gemini")).when(system == "sarvam", F.col("sarvam"))
    rows = rows.filter(letter | (F.col("part") == 1))  # a written decision stands once; copied words keep all their parts
    chosen = F.when(letter, copied).otherwise(F.col("text"))
    resolved = rows.select("call_id", F.col("first_position").alias("position"), F.trim(chosen).alias("text"),
                           F.concat(F.lit("resolved_"), F.coalesce(system, "choice")).alias("source"),
                           (F.col("unclear") | F.coalesce(F.contains(chosen, F.lit("[unclear]")), F.lit(False))).alias("unclear"), "merged", "speaker",
                           (~letter & (F.col("parts") > 1)).alias("whole"))
    out = agreed.unionByName(resolved).join(roles, ["call_id", "speaker"], "left")
    return out.withColumns({"role": F.coalesce("role", F.lit("unknown")), "dropped": F.coalesce(F.col("text"), F.lit("")) == ""})


def missing_decisions(spans, decisions):
    """Spans without a decision."""
    return spans.select("call_id", "span_id").distinct().join(decisions, ["call_id", "span_id"], "left_anti")


def speaker_samples(turns, k=3, chars=140):
    """First k turns of each speaker, cut to a short sample."""
    from pyspark.sql import Window
    rank = F.row_number().over(Window.partitionBy("call_id", "speaker").orderBy("turn"))
    return turns.withColumn("sample", rank).filter(F.col("sample") <= k).select("call_id", "speaker", "sample", F.left("text", F.lit(chars)).alias("text"))


def turn_times(turns, bucket=1024):
    """Monotone turn starts from first-heard times: a turn heard late or not at all takes the latest time before it.
    `turns` has call_id, turn, heard_at. The end is the next turn's start."""
    heard = F.coalesce(F.col("heard_at").cast("double"), F.lit(-1.0))
    rows = prefix_scan(turns, ["call_id"], ["turn"], F.floor(F.col("turn") / bucket), heard, "__upto", "max")
    rows = rows.withColumn("start", F.greatest(F.col("__upto"), F.lit(0.0)))
    rows = rows.withColumn("timed", F.coalesce((F.col("heard_at") >= F.col("start")), F.lit(False))).drop("__upto", "__total")
    placed = positions(rows, ["call_id"], ["turn"], F.floor(F.col("turn") / bucket), "__n")
    return neighbour(placed, ["call_id"], "__n", ["start"], 1, "next_").withColumnRenamed("next_start", "end").drop("__n")


def piece_starts(calls, duration="duration_seconds", size=PIECE_SECONDS, overlap=OVERLAP_SECONDS):
    """Start second of every piece a long call is cut into."""
    step = size - overlap
    more = F.greatest(F.lit(0), F.ceil((F.col(duration) - size) / step)).cast("bigint")
    return calls.select("call_id", F.explode(F.sequence(F.lit(0).cast("bigint"), more * step, F.lit(step).cast("bigint"))).alias("start_second"))


def parse_turns(texts, key="call_id", text="text"):
    """Labelled text as turns (key, turn, role, text): a labelled line opens a turn, other lines continue it. One pass
    inside each row: the text is cut before every label, so nothing is exploded to lines or shuffled."""
    lines = F.regexp_replace(F.col(text), LINE_BREAKS, "\n")
    chunks = F.filter(F.split(lines, r"(?m)(?=^" + TURN_LABEL + r")"), lambda c: c.rlike("^" + TURN_LABEL))
    role = lambda c: F.when(F.regexp_extract(c, "^" + TURN_LABEL, 1) == "Agent", "agent").otherwise("prospect")

    def body(c):
        said = F.transform(F.split(F.regexp_replace(c, "^" + TURN_LABEL, ""), "\n"), lambda line: F.trim(line))
        return F.array_join(F.concat(F.slice(said, 1, 1), F.filter(F.slice(said, 2, F.greatest(F.size(said), F.lit(1))), lambda line: line != "")), " ")

    turns = F.transform(chunks, lambda c: F.struct(role(c).alias("role"), body(c).alias("text")))
    return texts.select(key, F.posexplode(F.filter(turns, lambda x: x["text"] != "")).alias("at", "x")).select(
        key, (F.col("at") + 1).alias("turn"), "x.role", "x.text")


@F.udtf(returnType="turn: int, role: string, text: string")
class ParseTurns:
    """The same cut as a table function for lateral joins, `select ... from t, lateral parse_turns(t.text)`; a null text has no turns."""

    def eval(self, text: str):
        import re
        label, turns = re.compile(r"\s*\**(Agent|Customer)\**\s*:\s*\**\s*"), []
        for line in re.split("\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", text or ""):
            found = label.match(line)
            if found:
                turns.append(("agent" if found[1] == "Agent" else "prospect", [line[found.end():].strip(" ")]))
            elif turns and line.strip(" "):
                turns[-1][1].append(line.strip(" "))
        number = 0
        for role, lines in turns:
            said = " ".join(lines)
            if said:
                number += 1
                yield number, role, said


def register_parse_turns(spark, name="parse_turns"):
    """Make the table function known to SQL."""
    spark.udtf.register(name, ParseTurns)


PROVIDER_SCHEMA = ("transcript string, diarized_transcript struct<entries: array<struct<speaker_id: string, transcript: string, "
                   "start_time_seconds: double, end_time_seconds: double>>>")


def provider_turns(outputs, body="body"):
    """A provider's JSON output as its full text and speaker turns; blank turns are dropped."""
    j = F.from_json(F.col(body), PROVIDER_SCHEMA)
    kept = F.filter(F.coalesce(F.col("j.diarized_transcript.entries"), F.array().cast(
        "array<struct<speaker_id: string, transcript: string, start_time_seconds: double, end_time_seconds: double>>")),
        lambda e: F.trim(F.coalesce(e["transcript"], F.lit(""))) != "")
    turns = F.transform(kept, lambda e: F.struct(F.concat(F.lit("sarvam:"), e["speaker_id"]).alias("speaker"), F.trim(e["transcript"]).alias("text"),
                                                 e["start_time_seconds"].alias("start"), e["end_time_seconds"].alias("end")))
    rows = outputs.withColumn("j", j).withColumn("turns", turns)
    whole = F.when(F.coalesce(F.col("j.transcript"), F.lit("")) != "", F.col("j.transcript")).otherwise(F.array_join(F.transform("turns", lambda x: x["text"]), " "))
    return rows.withColumn("text", F.trim(whole)).drop("j")


def asr_flags(transcripts, segments):
    """Sorted flags per transcript: doubtful segments, no speech, and a duration far from the recorded one."""
    speech = F.trim(F.coalesce(F.col("text"), F.lit(""))) != ""
    doubtful = speech & ((F.coalesce(F.col("avg_logprob"), F.lit(0.0)) < -1) | (F.coalesce(F.col("compression_ratio"), F.lit(0.0)) > 2.4))
    per_call = segments.groupBy("call_id").agg(F.count_if(speech).alias("spoken"), F.some(doubtful).alias("doubtful"))
    rows = transcripts.join(per_call, "call_id", "left")
    far = F.abs(F.col("audio_seconds") - F.col("duration_seconds")) > F.greatest(F.lit(10.0), F.col("duration_seconds") * 0.1)
    flags = F.array(F.when(far, "audio_duration_differs_from_crm"), F.when(F.col("doubtful"), "asr_segment_needs_review"),
                    F.when(F.coalesce("spoken", F.lit(0)) == 0, "no_speech_transcribed"))
    return rows.select("call_id", F.array_sort(F.array_distinct(F.array_compact(flags))).alias("flags"))
