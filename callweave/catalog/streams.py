"""Streaming twins: each stream is drained and compared to the batch answer in SQL."""

from pyspark.sql import functions as F

from ..sources.bindings import SQL, ctes
from ..streaming import budget, late, ledger, refresh
from .base import ORACLE, query, rounded
from .worklist import BASE, GRADED



def stream(t, table, files=None):
    """A table as a stream, whether it is one file or a folder of parts (the path is a pattern, which matches either). By default a
    trigger takes all that is there, so that no layout or order of files decides what is late; a live job passes `files`."""
    reader = t.spark.readStream.schema(t.raw(table).schema)
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    return reader.parquet(f"{t.folder}/[{table[0]}]{table[1:]}.parquet")


def projected(t, name, table):
    """A binding over a stream: the same SELECT list."""
    body = SQL[name].strip()
    columns = body[len("select"):body.rindex("from {" + table + "}")]
    return t.spark.sql(f"select {columns} from {{source}}", source=stream(t, table))


@query("ledger_stream_costs", f"""with {ctes('ledger')}, w as (select time_bucket(interval 1 day, recorded_at) as start_at, stage, count(*) as events, round(sum(external_cost_inr), 4) as cost_inr,
  count(*) filter (status = 'failed') as failures from ledger group by 1, 2)
 select start_at, start_at + interval 1 day as end_at, stage, events, cost_inr, failures from w where start_at + interval 1 day <= (select max(recorded_at) - interval 1 day from ledger)""")
def ledger_stream_costs(t):
    rows = ledger.drain(ledger.daily_costs(projected(t, "ledger", "events")), "costs")
    return rounded(rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_at", "end_at")}), 4)


@query("ledger_stream_replays", f"with {ctes('ledger')} select distinct event_id, stage, status from ledger")
def ledger_stream_replays(t):
    """The ledger arrives twice; every event comes out once."""
    twice = projected(t, "ledger", "events").unionByName(projected(t, "ledger", "events"))
    return ledger.drain(ledger.without_replays(twice, "40 days").select("event_id", "stage", "status"), "replays")


@query("call_bursts", f"""with {ctes('ledger')}, g as (select *, case when recorded_at < lag(recorded_at) over w + interval 30 minutes then 0 else 1 end as new from ledger
   window w as (partition by call_id order by recorded_at, event_id)),
 s as (select *, sum(new) over (partition by call_id order by recorded_at, event_id rows unbounded preceding) as n from g)
 select call_id, min(recorded_at) as start_at, max(recorded_at) + interval 30 minutes as end_at, count(*) as events from s group by call_id, n
 having max(recorded_at) + interval 30 minutes <= (select max(recorded_at) - interval 1 hour from ledger)""")
def call_bursts(t):
    rows = ledger.drain(ledger.call_bursts(projected(t, "ledger", "events")), "bursts")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_at", "end_at")})


# Two halves of the ledger, by day of the month; every tenth event comes one part too late.
ARRIVAL = "day(recorded_at) div 16 + case when event_id % 10 = 0 then 1 else 0 end"
ARRIVAL_SQL = f"""with {ctes('ledger')}, a as (select *, day(recorded_at) // 16 + case when event_id % 10 = 0 then 1 else 0 end as arrival,
  time_bucket(interval 1 day, recorded_at) as start_at from ledger),
 parts as (select arrival, max(recorded_at) as latest from a group by 1),
 l as (select a.*, coalesce(start_at + interval 1 day < date_trunc('millisecond', (select max(latest) from parts p where p.arrival < a.arrival) - interval 1 day), false) as late
  from a)"""


def arrivals(rows, number, parts):
    """The rows in parts by an arrival number, and the end of the export as the last one."""
    return [rows.where(number == n) for n in range(parts)] + [late.end_of_export(rows, "recorded_at")]


def ledger_parts(t):
    return arrivals(t.ledger, F.expr(ARRIVAL), 3)


def moments(df, *names):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})


@query("ledger_settled_costs", ARRIVAL_SQL + """ select start_at, start_at + interval 1 day as end_at, stage, count(*) as events, round(sum(external_cost_inr), 4) as cost_inr,
  count(*) filter (status = 'failed') as failures, count(*) filter (late) as late_events from l group by 1, 2, 3""")
def ledger_settled_costs(t):
    """The ledger arrives in parts, some events late: closed windows and late rows together give the totals of all rows."""
    rows = late.settled_windows(late.drain_parts(ledger_parts(t), late.window_ledger, "settled-costs"))
    return rounded(moments(rows, "start_at", "end_at"), 4)


@query("ledger_late_rows", ARRIVAL_SQL + " select event_id, stage, start_at, recorded_at as at, round(external_cost_inr, 4) as cost_inr from l where late")
def ledger_late_rows(t):
    """Events that came after their window was closed, each as a row."""
    rows = late.drain_parts(ledger_parts(t), late.window_ledger, "late-rows").where("kind = 'late'")
    rows = rows.select("event_id", "stage", F.timestamp_micros("start_us").alias("start_at"), F.timestamp_micros("at_us").alias("at"), "cost_inr")
    return rounded(moments(rows, "start_at", "at"), 4)


@query("ledger_replays_in_parts", ORACLE["ledger_stream_replays"])
def ledger_replays_in_parts(t):
    """Two halves of the ledger, each of them written a second time after both: every event comes out once."""
    halves = [t.ledger.where(F.expr("day(recorded_at) div 16") == n) for n in range(2)]
    rows = late.drain_parts([*halves, *halves], lambda stream: ledger.without_replays(stream, "60 days").select("event_id", "stage", "status"), "replays-in-parts")
    return rows.where("event_id is not null")


@query("call_bursts_settled", f"""with {ctes('ledger')}, g as (select *, case when recorded_at < lag(recorded_at) over w + interval 30 minutes then 0 else 1 end as new from ledger
   window w as (partition by call_id order by recorded_at, event_id)),
 s as (select *, sum(new) over (partition by call_id order by recorded_at, event_id rows unbounded preceding) as n from g)
 select call_id, min(recorded_at) as start_at, max(recorded_at) + interval 30 minutes as end_at, count(*) as events from s group by call_id, n""")
def call_bursts_settled(t):
    """Sessions of events that arrive in parts: closed sessions and late rows together give the sessions of all rows."""
    rows = late.settled_sessions(late.drain_parts(ledger_parts(t), late.session_ledger, "settled-bursts"))
    return moments(rows, "start_at", "end_at")


@query("budget_stream", f"""with recursive {ctes('budget_events')}, steps as (
  select budget_id, request_id, event_id, ts, 0 as later, 'reserved' as status, reserve_inr as inr from budget_events
  union all select budget_id, request_id, event_id, ts + interval 6 hours, 1, final_status, final_inr from budget_events where final_status <> 'reserved'),
 n as (select *, row_number() over (partition by budget_id order by ts, later, event_id) as n from steps),
 r as (select budget_id, cast(0 as bigint) as n, '' as request_id, cast(null as timestamp) as ts, '' as decision, cast(0 as double) as committed,
   cast([] as struct(request_id varchar, inr double)[]) as open from (select distinct budget_id from n)
  union all
  select n.budget_id, n.n, n.request_id, n.ts, case when later = 0 then case when committed + inr > 9000 then 'refused' else 'accepted' end when h is null then 'ignored'
     when n.status = 'usage_reported' then 'settled' when n.status = 'rejected_not_billed' then 'released' else 'kept' end,
   case when later = 0 then case when committed + inr > 9000 then committed else committed + inr end when h is null then committed
     when n.status = 'usage_reported' then committed + inr - h when n.status = 'rejected_not_billed' then committed - h else committed end,
   case when later = 1 then list_filter(open, lambda x: x.request_id <> n.request_id) when committed + inr > 9000 then open
     else list_append(open, struct_pack(request_id := n.request_id, inr := inr)) end
  from (select r.committed, r.open, n.*, list_filter(r.open, lambda x: x.request_id = n.request_id)[1].inr as h from r join n on n.budget_id = r.budget_id and n.n = r.n + 1) n)
 select budget_id, request_id, ts, decision, round(committed, 4) as committed_inr from r where n > 0""")
def budget_stream(t):
    """Accept / refuse decisions per budget under a cap that most budgets reach; the requests arrive in three parts."""
    rows = t.budget_events
    parts = [rows.where(F.expr("day(ts) div 11") == n) for n in range(3)] + [late.end_of_export(rows, "ts")]
    out = late.drain_parts(parts, lambda stream: budget.enforce(budget.steps(stream), 9000.0), "budget")
    return rounded(moments(out.drop("late"), "ts"), 4)


def call_parts(t, n=3):
    return [t.calls.where(F.col("source_row") % n == k) for k in range(n)]


SHOWN = "select lead, category, reason, cast(days_since as int) as days_since, cast(as_of as varchar) as as_of from graded"


@query("daily_refresh", f"with {BASE}, {GRADED} {SHOWN}")
def daily_refresh(t):
    """The calls arrive in three parts: the refreshed worklist equals the batch one over all of them."""
    return refresh.run(call_parts(t), t.codings)[0]


@query("refresh_of_half", f"with {ctes('calls').replace('calls as (', 'all_calls as (', 1)}, calls as (select * from all_calls where source_row % 4 < 2), {ctes('codings')}, {GRADED} {SHOWN}")
def refresh_of_half(t):
    """Two of four parts have come: the worklist equals the batch one over these two."""
    return refresh.run(call_parts(t, 4)[:2], t.codings)[0]


@query("journey_state", f"""with {ctes('calls')}, b as (select lead, count(*) as calls, bool_or(coalesce(flag, '') = 'Yes') as any_yes,
   min((created_on, call_id)) filter (conversation_type in ('enrollment_or_payment', 'learner_support', 'administrative')) as boundary,
   max((created_on, call_id)) filter (conversation_type <> 'unusable') as live from calls group by lead)
 select b.lead, b.calls, any_yes, boundary[2] as boundary_call_id, live[2] as live_call_id, count(*) filter (live is null or (c.created_on, c.call_id) > live) as attempts_since
 from b join calls c on c.lead = b.lead group by all""")
def journey_state(t):
    """What the refresh knows of each lead's journey after three parts."""
    rows = refresh.run(call_parts(t), t.codings)[1].journeys()
    return rows.select("lead", "calls", "any_yes", F.col("boundary.call_id").alias("boundary_call_id"), "live_call_id", "attempts_since")
