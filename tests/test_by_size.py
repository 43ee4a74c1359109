"""Ordinary keys take a plain window, large keys are cut into buckets: both give the same rows. Spans, decisions and quotes on either way."""

import pytest
from pyspark.sql import functions as F

from callweave.operators import claims as cl
from callweave.operators import consensus as cs
from callweave.operators import ranking

VOTES = [(call, pos, *texts, speaker) for call, pos, texts, speaker in [
    ("A", 1, ("a", "b", "c"), "one"), ("A", 2, ("a", None, "d"), "two"), ("A", 3, ("a", "a", "a"), "one"), ("A", 4, ("x", "y", "z"), None),
    ("A", 5, ("x", "y", "z"), None), ("A", 6, ("p", "q", "q"), "two"), ("B", 1, ("m", "m", "n"), "one"), ("B", 2, ("k", "l", "j"), "two"), (None, 1, ("e", "f", "g"), "one")]]
VOTE = "call_id string, segment_pos int, whisper string, gemini string, sarvam string, speaker string"
ways = pytest.mark.parametrize("plain_rows", [100_000, 1])


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def decided(spark):
    placed = cs.place(cs.vote(spark.createDataFrame(VOTES, VOTE)))
    spans = cs.disputed_segments(placed)
    decisions = spark.createDataFrame([("A", 0, "A", None, False), ("A", 1, "combined", "both", True), ("B", 0, "C", None, False)],
                                      "call_id string, span_id bigint, choice string, text string, unclear boolean")
    roles = spark.createDataFrame([("A", "one", "agent")], "call_id string, speaker string, role string")
    return placed, spans, cs.build(placed, spans, decisions, roles)


@ways
def test_spans_and_decisions_do_not_depend_on_the_size_of_a_call(spark, rows, monkeypatch, plain_rows):
    monkeypatch.setattr(ranking, "PLAIN_ROWS", plain_rows)
    placed, spans, built = decided(spark)
    assert rows(placed.select("call_id", "segment_pos", "position")) == sorted([(v[0], v[1], v[1]) for v in VOTES], key=repr)
    assert rows(spans.select("call_id", "position", "span_id")) == sorted([("A", 1, 0), ("A", 2, 0), ("A", 4, 1), ("A", 5, 1), ("B", 2, 0), (None, 1, 0)], key=repr)
    assert rows(cs.disputed_spans(spans, 1).select("call_id", "span_id", "part", "first_position", "segments", "gemini")) == [
        ("A", 0, 1, 1, 1, "b"), ("A", 0, 2, 2, 1, ""), ("A", 1, 1, 4, 1, "y"), ("A", 1, 2, 5, 1, "y"), ("B", 0, 1, 2, 1, "l")]
    texts = {("A", 0): {"whisper": "a a", "gemini": "b", "sarvam": "c d"}, ("B", 0): {"whisper": "k", "gemini": "l", "sarvam": "j"}}
    order = {(r["call_id"], r["span_id"]): r["o"] for r in spans.select("call_id", "span_id", cs.candidate_order(F.col("call_id"), F.col("span_id")).alias("o")).collect()}
    first, last = order["A", 0][0], order["B", 0][2]
    assert rows(built.where("source not in ('agreed', 'majority_whisper', 'majority_gemini_sarvam')").select("call_id", "position", "text", "source", "merged", "unclear", "role")) == sorted([
        ("A", 1, texts["A", 0][first], "resolved_" + first, 2, False, "agent"), ("A", 4, "both", "resolved_combined", 2, True, "unknown"),
        ("B", 2, texts["B", 0][last], "resolved_" + last, 1, False, "unknown")], key=repr)


@ways
def test_a_written_decision_has_the_segments_of_all_parts(spark, rows, monkeypatch, plain_rows):
    monkeypatch.setattr(ranking, "PLAIN_ROWS", plain_rows)
    n = 4500
    segments = [(call, i + 1, f"{call}{i:05}", "w", "g", "s", "one", "disputed", float(i), i + 0.5) for call in "AB" for i in range(n)]
    segments += [("A", n + 1, "same", "t", "t", "t", "one", "agreed", 1.0, 2.0)]
    placed = spark.createDataFrame(segments, "call_id string, position bigint, segment_pos string, whisper string, gemini string, sarvam string, speaker string, outcome string, "
                                             "start double, end double")
    spans = placed.where("outcome = 'disputed'").withColumn("span_id", F.lit(0).cast("bigint"))
    decisions = spark.createDataFrame([("A", 0, "combined", "both", False), ("B", 0, "B", None, False)], "call_id string, span_id bigint, choice string, text string, unclear boolean")
    roles = spark.createDataFrame([("A", "one", "agent")], "call_id string, speaker string, role string")
    got = cs.framed(cs.build(placed, spans, decisions, roles), placed, spans)
    ids = lambda call, a, b: [f"{call}{i:05}" for i in range(a, b)]
    assert "whole" not in got.columns
    assert rows(got.select("call_id", "position", "merged", "start", "end", "merged_ids")) == sorted([
        ("A", 1, n, 0.0, n - 0.5, ids("A", 0, n)), ("A", n + 1, 1, 1.0, 2.0, ["same"]), ("B", 1, n, 0.0, 1999.5, ids("B", 0, 2000)),
        ("B", 2001, n, 2000.0, 3999.5, ids("B", 2000, 4000)), ("B", 4001, n, 4000.0, n - 0.5, ids("B", 4000, n))], key=repr)


def test_a_decision_is_digested_once_and_spans_are_not_joined_to_their_own_size(spark):
    built = plan(decided(spark)[2])
    assert built.count("sha2(") == 3 and "checkpoint" not in built and "ExistingRDD" not in built


def test_ordinary_keys_are_not_joined_to_bucket_totals(spark):
    df = spark.range(9).select((F.col("id") % 2).alias("k"), "id")
    assert plan(ranking.positions_by_size(df, ["k"], ["id"], F.col("id"))).count("Join LeftAnti") == 1


@ways
def test_rows_without_a_bucket_come_first(spark, rows, monkeypatch, plain_rows):
    monkeypatch.setattr(ranking, "PLAIN_ROWS", plain_rows)
    items = spark.createDataFrame([("C", "signals", None), ("C", "facts", "1-0000000002"), ("C", "facts", "1-0000000001")], "call_id string, collection string, item_pos string")
    assert rows(cl.number_claims(items).select("claim_id", "item_pos")) == [(1, None), (2, "1-0000000001"), (3, "1-0000000002")]


def quoted(spark):
    lines = [("C", 0, "The gate opens"), ("C", 1, "at seven on weekdays."), ("C", 5, "Tickets cost"), ("C", 9, "ten coins."), (None, 0, "The gate")]
    evidence = [("C", "a", 0, "opens at seven"), ("C", "b", 0, "at seven"), ("C", "c", 5, "weekdays tickets"), ("C", "d", 9, "cost ten"), ("C", "e", 7, "gate"), ("C", "f", 1, "cost ten"),
                (None, "g", 0, "the gate"), ("C", "h", 0, "no such words"), ("C", "h", 5, "cost ten"), ("C", "i", 1, None), ("C", None, 0, "opens at seven")]
    return cl.unsupported_places(spark.createDataFrame(evidence, "call_id string, place string, segment_id bigint, quote string"),
                                 spark.createDataFrame(lines, "call_id string, segment_id bigint, text string"))


@ways
def test_quotes_run_into_neighbours_whatever_the_size_of_a_call(spark, rows, monkeypatch, plain_rows):
    monkeypatch.setattr(ranking, "PLAIN_ROWS", plain_rows)
    assert rows(quoted(spark)) == sorted([("C", "b"), ("C", "e"), ("C", "f"), (None, "g"), ("C", "i"), ("C", None)], key=repr)


def test_a_citation_is_not_joined_to_its_neighbours(spark):
    assert "explode" not in plan(quoted(spark))


def test_client_texts_are_computed_once(spark, monkeypatch):
    from callweave.plans import publication as pb
    one = lambda text: spark.range(2).select(F.col("id").cast("string").alias("lead"), F.lit(text).alias("text"), F.lit("c").alias("call_id"), F.lit("d").alias("created_on"))
    monkeypatch.setattr(pb, "settle", lambda df: df)
    for name, text in {"graded": "", "review_claims": "", "review_sheet": "", "worklist_rows": "Ask Meera about it", "journey_rows": "Hello about"}.items():
        monkeypatch.setattr(pb.wl, name, lambda *a, _text=text, **k: one(_text))
    monkeypatch.setattr(pb, "call_rows", lambda *a: one("ask hello Tara"))
    monkeypatch.setattr(pb, "internal_rows", lambda *a: one(""))
    monkeypatch.setattr(pb.wl, "review_status", lambda sheet: spark.range(1).select(F.lit(True).alias("complete")))
    monkeypatch.setattr(pb.wl, "category_counts", lambda graded: graded)
    audit = spark.range(1).select(F.lit(True).alias("complete"), F.lit(1).alias("audit_reviewed"))
    record = {k: "2026-01-01" for k in ("as_of", "rule_hash", "frozen_at", "first_frozen_at")}
    tables = pb.tables_of(one(""), one(""), one(""), one(""), one(""), audit, one(""), one(""), one(""), one(""), record, one(""), one(""), one(""))
    assert {r["word"] for r in tables["possible_names"].collect()} == {"Meera", "Tara"}
    assert plan(tables["possible_names"]).count("parquet") == 6 and "Range" not in plan(tables["possible_names"])
