"""Shares of heard words: keys that repeat or are missing, calls without a transcript, no shuffle of single words, and one shuffle of claims and verdicts."""

from pyspark.sql import functions as F

from callweave.operators import claims as cl
from callweave.session import setting

QUOTES = "citation_id string, call_id string, quote string"


def shares(spark):
    quotes = spark.createDataFrame([("a", "C1", "the price the Fee"), ("b", "C1", "um, never"), ("b", "C2", "hello there"), ("c", "C3", "any words"),
                                    ("d", None, "the price"), (None, "C1", "never"), (None, "C2", "hello"), ("e", "C1", None), ("f", "C1", "..."), ("g", "C2", "hello"), ("g", "C2", "hello")], QUOTES)
    other = spark.createDataFrame([("C1", "The price."), ("C1", "the cost"), ("C2", "Hello, there"), (None, "the price"), ("C2", None)], "call_id string, text string")
    return cl.heard_share(quotes, other)


def test_shares_of_repeated_and_missing_keys(spark):
    got = sorted((r["citation_id"] or "", r["call_id"] or "", r["share"], r["heard"]) for r in shares(spark).collect())
    assert got == sorted([("a", "C1", 0.75, True), ("b", "C1", 2 / 3, True), ("b", "C2", 2 / 3, True), ("c", "C3", 0.0, False), ("d", "", 0.0, False), ("", "C1", None, True),
                          ("", "C2", None, True), ("e", "C1", None, True), ("f", "C1", None, True), ("g", "C2", 1.0, True), ("g", "C2", 1.0, True)], key=lambda r: r[:2])


def test_words_of_quotes_are_not_shuffled_singly(spark):
    df = shares(spark)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and plan.count("Generate ") == 1 and plan.count("Join ") == 1


def test_an_unheard_quote_holds_its_claim(spark):
    merged = spark.createDataFrame([("C1", "1", True), ("C1", "2", True), ("C1", "3", False), ("C2", None, True)], "call_id string, item_pos string, kept boolean")
    heard = spark.createDataFrame([("C1", "1", True), ("C1", "1", False), ("C1", "1", False), ("C1", "2", True), ("C1", "3", False), ("C2", None, False)],
                                  "call_id string, item_pos string, heard boolean")
    got = {(r["call_id"], r["item_pos"]): (r["kept"], r["unconfirmed"]) for r in cl.hold_unheard(merged, heard).collect()}
    assert got == {("C1", "1"): (False, True), ("C1", "2"): (True, False), ("C1", "3"): (False, False), ("C2", None): (True, False)}


ITEM = "call_id string, item_pos string, collection string, label string, text string, resolution string, resolution_segment_id int"
ITEMS = [("A", "1", "facts", "goal", "the price", None, None), ("A", "2", "objections", "price", "never said", "resolved", 3), ("A", "2", "objections", "price", "the cost", "resolved", None),
         ("A", "3", "pitches", "pitch", "the cost", None, None), ("A", None, "facts", "goal", "the price", None, None), ("B", "1", "signals", "do_not_contact", "hello", None, None),
         ("B", "2", "pitches", "pitch", "hello", None, None), ("C", "1", "facts", "goal", "anything", None, None), (None, "1", "facts", "goal", "hello", None, None)]
VERDICTS = [("A", "1", "supported", None, "r1"), ("A", "2", "overstated", "unclear", "r2"), ("A", "2", "supported", None, "r3"), ("A", None, "supported", None, "r4"),
            ("B", "1", "supported", None, None), ("B", "2", "supported", None, "r5"), ("B", "9", "supported", None, "r6"), (None, "1", "supported", None, "r7")]


def merged(spark):
    types = spark.createDataFrame([("A", "sales"), ("B", "administrative")], "call_id string, conversation_type string")
    return cl.merge(spark.createDataFrame(ITEMS, ITEM), spark.createDataFrame(VERDICTS, "call_id string, item_pos string, verdict string, corrected_resolution string, reason string"), types)


def held(spark):
    other = spark.createDataFrame([("A", "The price, the cost"), ("B", "goodbye")], "call_id string, text string")
    quotes = F.array(F.struct(F.lit(0).alias("k"), F.col("text").alias("quote")), F.struct(F.lit(1).alias("k"), F.lit("the").alias("quote")))
    heard = cl.heard_share(merged(spark).select("*", F.inline(quotes)), other, ("call_id", "item_pos", "k"))
    return heard, cl.hold_unheard(heard, first=F.col("k") == 0)


def test_every_verdict_of_an_item_meets_it_and_missing_keys_meet_none(spark, rows):
    assert rows(merged(spark).select("call_id", "item_pos", "text", "verdict", "reason", "tier", "resolution", "resolution_segment_id", "kept")) == sorted([
        ("A", "1", "the price", "supported", "r1", "verified", None, None, True),
        ("A", "2", "never said", "overstated", "r2", "verified_corrected", "unclear", None, True), ("A", "2", "never said", "supported", "r3", "verified", "resolved", 3, True),
        ("A", "2", "the cost", "overstated", "r2", "verified_corrected", "unclear", None, True), ("A", "2", "the cost", "supported", "r3", "verified", "resolved", None, True),
        ("A", "3", "the cost", None, None, "needs_review", None, None, False), ("A", None, "the price", None, None, "needs_review", None, None, False),
        ("B", "1", "hello", "supported", None, "verified", None, None, True), ("B", "2", "hello", "supported", "r5", "excluded_service_call", None, None, False)], key=repr)


def test_quotes_beside_their_claims_hold_them_as_joined_ones_do(spark, rows):
    heard, beside = held(spark)
    columns = ["call_id", "item_pos", "text", "verdict", "tier", "kept", "unconfirmed"]
    apart = cl.hold_unheard(merged(spark), heard.select("call_id", "item_pos", "heard"))
    assert rows(beside.select(columns)) == rows(apart.select(columns))
    assert {(r["call_id"], r["item_pos"]) for r in beside.where("unconfirmed").collect()} == {("A", "2"), ("B", "1")}


def test_claims_are_dealt_by_call_once(spark):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = held(spark)[1]._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert "item_pos" not in "".join(dealt) and len(dealt) == 3
