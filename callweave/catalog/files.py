"""Round trips: the given tables written by a sink and read back by its source."""

from pyspark.sql import functions as F

from ..session import work_folder
from ..sources import readers, sinks
from ..sources.bindings import ctes
from ..streaming import ledger as lg
from .base import query, rounded

CELL = lambda c: f"case when regexp_matches(coalesce({c}, ''), '^\\s*[=+\\-@]') then '''' || {c} else coalesce({c}, '') end"


@query("corpus_round_trip", f"""with {ctes('extractions')} select call_id, summary, next_action, cast(model_no as bigint) as model_no from extractions""")
def corpus_round_trip(t):
    """One JSON document per call, in buckets."""
    folder = work_folder(t.spark, "corpus")
    docs = t.extractions.select("call_id", F.to_json(F.struct("summary", "next_action", "model_no")).alias("body"))
    sinks.write_corpus(docs, folder, "call_id", "body", 16)
    return readers.corpus(t.spark, folder, "summary string, next_action string, model_no bigint").withColumnRenamed("id", "call_id")


@query("ledger_round_trip", f"""with {ctes('ledger')} select event_id::varchar as event_id, recorded_at, stage, call_id, status, round(external_cost_inr, 4) as external_cost_inr from ledger""")
def ledger_round_trip(t):
    """The ledger in three appended batches, one of them run twice, read as a stream."""
    folder = work_folder(t.spark, "ledger")
    rows = t.ledger.select(F.col("event_id").cast("string").alias("event_id"), "recorded_at", "stage", "call_id", "status", "external_cost_inr")
    for batch in (0, 1, 2, 1):
        sinks.append_batch(rows.where(F.col("event_id").cast("bigint") % 3 == batch), folder, batch)
    stream = readers.ledger_stream(t.spark, f"{folder}/batch=*", files_per_trigger=1000)
    return rounded(lg.drain(stream, "ledger-copy").select("event_id", "recorded_at", "stage", "call_id", "status", "external_cost_inr"), 4)


@query("csv_round_trip", f"""select event_id::varchar as event_id, {CELL('cell')} as cell, {CELL('props')} as props from (select event_id, case event_id % 7 when 0 then '=SUM(A1:A2)' when 1 then ' @x'
 when 2 then '-1+2' when 3 then null when 4 then 'line' || chr(10) || 'two "quoted", three' else event_type end as cell, props from events)""")
def csv_round_trip(t):
    """A sheet with formulas, quotes and line breaks, written for a spreadsheet and read back as text."""
    folder = work_folder(t.spark, "sheet")
    cell = F.expr("""case event_id % 7 when 0 then '=SUM(A1:A2)' when 1 then ' @x' when 2 then '-1+2' when 3 then null when 4 then 'line\\ntwo "quoted", three' else event_type end""")
    sinks.write_csv(t.raw("events").select("event_id", cell.alias("cell"), "props"), folder)
    return readers.review_sheet(t.spark, folder).select("event_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("cell", "props")])


@query("call_table_round_trip", f"""with {ctes('calls')} select call_id, lead, cast(created_on as timestamp) as created_on, duration_seconds, flag from calls""")
def call_table_round_trip(t):
    """The call table as CSV with its required columns checked."""
    folder = work_folder(t.spark, "calls") + ".csv"
    t.calls.select("call_id", "lead", F.col("created_on").cast("timestamp_ntz").alias("created_on"), "duration_seconds", "flag").write.option("header", True).csv(folder)
    return readers.call_table(t.spark, folder, ("call_id", "lead", "created_on"), "call_id string, lead string, created_on timestamp_ntz, duration_seconds int, flag string")


@query("transcript_files", f"""with {ctes('segments')} select call_id || ' ' || call_id || ' [' || printf('%02d:%02d', cast(floor(start / 60) as bigint), cast(floor(start) as bigint) % 60) || '] '
 || case role when 'agent' then 'COUNSELLOR' when 'prospect' then 'LEAD' else 'SPEAKER' end || ': ' || regexp_replace(text, '[\\r\\n]+', ' ', 'g') as line from segments""")
def transcript_files(t):
    """Transcripts in buckets by lead; each call plays its own lead here. A line is a line: breaks inside a text become spaces."""
    folder = work_folder(t.spark, "transcripts")
    lines = t.segments.select(F.col("call_id").alias("lead"), "call_id", "segment_id", "role", "start", F.regexp_replace("text", r"[\r\n]+", " ").alias("text"))
    sinks.write_transcript_buckets(lines, folder, 16)
    return t.spark.read.text(folder).select(F.col("value").alias("line"))


@query("json_round_trip", f"""with {ctes('leads')} select lead, lead_name, round(balance, 4) as balance from leads""")
def json_round_trip(t):
    """A JSON dataset replaced as a whole."""
    folder = work_folder(t.spark, "json")
    rows = t.leads.select("lead", "lead_name", "balance")
    sinks.write_json(rows.limit(3), folder)
    sinks.write_json(rows, folder)
    return rounded(t.spark.read.schema("lead string, lead_name string, balance double").option("mode", "FAILFAST").json(folder), 4)
