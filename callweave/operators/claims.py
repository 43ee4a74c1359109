"""Extracted claims: statements, schema and citation checks, verdict merge and the independent-transcript tripwire.

Items are long: one row per extracted item, keyed (call_id, collection, item_pos)."""

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .ranking import by_size, neighbour, positions, positions_by_size
from .small import case_of

# ---- fixed values ----
COLLECTIONS = {"facts": 0, "signals": 1, "objections": 2, "pitches": 3}
SERVICE_TYPES = ("learner_support", "administrative")
TRIPWIRE_MIN_SHARE = 0.6
FIELD_LENGTHS = {"value": 400, "quote": 10000}
# ---- end of fixed values ----


def item_bucket():
    """Leading part of an item's place in its call, for prefix positions."""
    return F.concat(case_of(F.col("collection"), COLLECTIONS).cast("string"), F.left("item_pos", F.lit(9)))


def number_claims(items):
    """claim_id 1.. in collection order; 0 is the call's purpose."""
    ranked = items.withColumn("__c", case_of(F.col("collection"), COLLECTIONS))
    return positions_by_size(ranked, ["call_id"], ["__c", "item_pos"], item_bucket(), "claim_id").drop("__c")


def statements(items):
    """One checkable statement per item with the segments it cites."""
    c = F.col
    said = F.coalesce(c("response"), F.lit("none recorded"))
    statement = (F.when(c("collection") == "facts", F.concat(F.lit("Prospect's "), "label", F.lit(": "), "text"))
                 .when(c("collection") == "signals", F.concat(F.lit("Signal "), "label", F.lit(": "), "text"))
                 .when(c("collection") == "objections", F.concat(F.lit("Prospect objection ("), "label", F.lit("): "), "text",
                                                                 F.lit(". Agent response: "), said, F.lit(". Resolution: "), "resolution"))
                 .otherwise(F.concat(F.lit("Agent pitch: "), "text", F.lit(". Prospect response: "), said)))
    segments = F.array_compact(F.array("segment_id", "response_segment_id", "resolution_segment_id"))
    return items.withColumns({"statement": statement, "segments": segments})


def purpose_claims(calls, purposes):
    """Claim 0 of every call."""
    return calls.join(purposes.select("call_id", "purpose_segment_id"), "call_id", "left").select(
        "call_id", F.lit(0).cast("bigint").alias("claim_id"), F.lit("conversation_type").alias("collection"),
        F.concat(F.lit("The call's purpose is: "), "conversation_type").alias("statement"),
        F.array_compact(F.array("purpose_segment_id")).alias("segments"))


def call_types(calls, purpose_verdicts):
    """Each call's type after the purpose verdict: a named correction replaces it, but a typed call needs a purpose quote."""
    rows = calls.select("call_id", "conversation_type").join(purpose_verdicts, "call_id", "left")
    typed = F.col("corrected_type").isNotNull() & ~F.coalesce(F.col("corrected_type"), F.lit("")).isin("unclear", "unusable")
    wrong = F.coalesce(F.col("verdict") != "supported", F.lit(False))
    corrected = F.when(wrong & ~(typed & F.col("purpose_segment_id").isNull()), F.col("corrected_type"))
    return rows.select("call_id", F.col("conversation_type").alias("original_type"), corrected.alias("corrected_to"),
                       F.coalesce(corrected, "conversation_type").alias("conversation_type"),
                       F.when(wrong, F.when(corrected.isNotNull(), "corrected").otherwise("needs_review")).alias("purpose_tier"))


def judged(items, verdicts, types):
    """Items beside each of their verdicts, if any, and their call's type. Items and verdicts are dealt by call in one shuffle and meet in a window of the item:
    a join on call and item would deal them by both, and again by call for all that is known of the call. The type comes before the verdicts are taken
    apart, while the window's order still serves the join."""
    keys = ["call_id", "item_pos"]
    found = [c for c in verdicts.columns if c not in keys]
    known = items.filter(F.col("call_id").isNotNull()).withColumn("__item", F.lit(True))
    given = verdicts.filter(F.col("call_id").isNotNull() & F.col("item_pos").isNotNull()).withColumn("__item", F.lit(False))
    both = known.unionByName(given, allowMissingColumns=True).repartition("call_id")
    same = Window.partitionBy(*keys)
    # A list per column and not one of whole verdicts, so that columns nobody reads are not shuffled.
    lists = {c: F.collect_list(F.when(~F.col("__item"), F.struct(F.col(c).alias("x")))).over(same) for c in found}
    rows = both.withColumns({"__verdicts": F.count_if(~F.col("__item")).over(same)} | {f"__of_{c}": x for c, x in lists.items()}).filter("__item")
    rows = rows.join(types.select("call_id", "conversation_type"), "call_id").withColumn("__at", F.explode(F.sequence(F.lit(1).cast("bigint"), F.greatest("__verdicts", F.lit(1)))))
    return rows.select(*items.columns, *[F.get(f"__of_{c}", F.col("__at").cast("int") - 1)["x"].alias(c) for c in found], "conversation_type")


def merge(items, verdicts, types):
    """Tier, resolution and keep flag per claim. Only the type's columns travel with the items, and what words decide about the tier is read before."""
    sales = (F.col("collection") != "facts") & ~((F.col("collection") == "signals") & (F.col("label") == "do_not_contact"))
    items = items.withColumns({"__sales": sales, "__objection": F.col("collection") == "objections"})
    verdicts = verdicts.withColumns({"__supported": F.col("verdict") == "supported", "__lowers": (F.col("verdict") == "overstated") & F.col("corrected_resolution").isNotNull()})
    rows = judged(items, verdicts, types)
    lowered = F.coalesce(F.col("__lowers") & F.col("__objection"), F.lit(False))
    service = F.col("conversation_type").isin(*SERVICE_TYPES) & F.col("__sales")
    tier = F.when(service, "excluded_service_call").when(F.col("__supported"), "verified").when(lowered, "verified_corrected").otherwise("needs_review")
    rows = rows.withColumns({
        "tier": tier, "resolution": F.when(lowered, F.col("corrected_resolution")).otherwise(F.col("resolution")),
        "resolution_segment_id": F.when(~lowered, F.col("resolution_segment_id"))}).withColumn(
        "kept", F.col("tier").isin("verified", "verified_corrected"))
    return rows.drop("__sales", "__objection", "__supported", "__lowers")


def tier_counts(merged, by=()):
    return merged.groupBy(*by, "tier").agg(F.count(F.lit(1)).alias("claims"))


def verdict_gaps(items, verdicts):
    """Claims without exactly one verdict, and verdicts without a claim."""
    counts = verdicts.groupBy("call_id", "item_pos").agg(F.count(F.lit(1)).alias("n"))
    joined = items.select("call_id", "item_pos", F.lit(True).alias("claimed")).join(counts, ["call_id", "item_pos"], "full_outer")
    problem = (F.when(F.col("claimed").isNull(), "verdict without a claim").when(F.col("n").isNull(), "claim without a verdict")
               .when(F.col("n") > 1, "more than one verdict"))
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select("call_id", "item_pos", "problem")


def schema_problems(raw, fields, body="body"):
    """Rows of JSON items that break the closed schema: unparsable, unknown key, wrong value, blank or long text."""
    j = F.from_json(F.col(body), "field string, value string, evidence struct<segment_id: bigint, quote: string>")
    keys = F.json_object_keys(F.col(body))
    extra = F.array_except(keys, F.array(*[F.lit(k) for k in ("field", "value", "evidence")]))
    rows = raw.withColumns({"j": j, "extra": extra})
    value, quote = F.col("j.value"), F.col("j.evidence.quote")
    rules = [(keys.isNull(), F.lit("not a JSON object")), (F.size("extra") > 0, F.concat(F.lit("unknown key "), F.array_join("extra", ", "))),
             (~F.coalesce(F.col("j.field").isin(*fields), F.lit(False)), F.lit("field not allowed")),
             (~F.coalesce(F.length(value).between(1, FIELD_LENGTHS["value"]), F.lit(False)), F.lit("value length")),
             (~F.coalesce(F.col("j.evidence.segment_id") >= 0, F.lit(False)), F.lit("segment_id below 0")),
             (~F.coalesce((F.trim(quote) != "") & (F.length(quote) <= FIELD_LENGTHS["quote"]), F.lit(False)), F.lit("quote blank or too long"))]
    problems = F.array_compact(F.array(*[F.when(cond, what) for cond, what in rules]))
    return rows.select("call_id", "item_pos", F.explode(problems).alias("problem"))


def structure_problems(calls, items, purposes):
    """Missing evidence and service calls with sales content; item places are `collection[index].key`."""
    index = positions_by_size(items, ["call_id", "collection"], ["item_pos"], F.left("item_pos", F.lit(9)), "__n")
    place = F.concat("collection", F.lit("["), (F.col("__n") - 1).cast("string"), F.lit("]."))
    objection = F.col("collection") == "objections"
    rules = [(F.col("collection").isin("objections", "pitches") & F.col("response").isNotNull() & F.col("response_segment_id").isNull(), "response_missing_evidence"),
             (objection & (F.col("resolution") == "resolved") & F.col("resolution_segment_id").isNull(), "resolution_missing_evidence")]
    cells = F.array_compact(F.array(*[F.when(cond, F.concat(place, F.lit(name))) for cond, name in rules]))
    item_rows = index.select("call_id", F.explode(cells).alias("problem"))
    sales = items.filter(F.col("collection").isin("objections", "pitches") | ((F.col("collection") == "signals") & (F.col("label") != "do_not_contact")))
    service = calls.filter(F.col("conversation_type").isin(*SERVICE_TYPES)).join(sales.select("call_id"), "call_id", "left_semi")
    unproved = calls.filter(~F.col("conversation_type").isin("unclear", "unusable")).join(
        purposes.filter(F.col("purpose_segment_id").isNotNull()).select("call_id"), "call_id", "left_anti")
    named = lambda df, name: df.select("call_id", F.lit(name).alias("problem"))
    return item_rows.unionByName(named(service, "service_call_has_sales_content")).unionByName(named(unproved, "purpose_missing_evidence"))


def place_segments(segments):
    """Segments with their position in the call's order (ids may have gaps), their comparable text (`said`), and id and text of the segments before and
    after (`before`, `after`), which travel with them so that no citation is joined a second time."""
    rows = segments.select("call_id", "segment_id", tx.normalise(F.col("text")).alias("said"))
    beside = {"before": -1, "after": 1}

    def plain(rows):
        along = Window.partitionBy("call_id").orderBy("segment_id")
        found = {name: F.lead(F.struct(F.lit(True).alias("there"), F.col("segment_id").alias("id"), "said"), offset).over(along) for name, offset in beside.items()}
        return rows.withColumns({"position": F.row_number().over(along).cast("bigint")} | found)

    def cut(rows):
        placed = positions(rows, ["call_id"], ["segment_id"], F.floor(F.col("segment_id") / 1024))
        text = placed.withColumn("x", F.struct(F.lit(True).alias("there"), F.col("segment_id").alias("id"), "said"))
        for name, offset in beside.items():
            text = neighbour(text, ["call_id"], "position", ["x"], offset, name + "_").withColumnRenamed(name + "_x", name)
        return text.drop("x")

    return by_size(rows, ["call_id"], plain, cut)


def quote_support(citations, segments, key="citation_id"):
    """Adds `supported`: the quote lies in the cited segment, or runs from it into the segment before or after. `key` names the citation, by one column
    or several; it is supported when any row of it is."""
    placed = place_segments(segments).drop("position")
    rows = citations.withColumn("wanted", tx.normalise(F.col("quote"))).join(placed, ["call_id", "segment_id"], "left")
    wanted, said = F.col("wanted"), F.col("said")

    def runs_into(other):
        joined = F.when(other["id"] < F.col("segment_id"), F.concat_ws(" ", other["said"], said)).otherwise(F.concat_ws(" ", said, other["said"]))
        return F.coalesce(F.contains(joined, wanted) & ~F.contains(other["said"], wanted), F.lit(False))

    inside = F.coalesce((wanted != "") & F.contains(said, wanted), F.lit(False))
    spilled = ~inside & F.coalesce(said.isNotNull() & (wanted != ""), F.lit(False)) & (runs_into(F.col("before")) | runs_into(F.col("after")))
    rows = rows.withColumns({"inside": inside, "spilled": spilled}).drop("wanted", "said", "before", "after")
    keys = [key] if isinstance(key, str) else list(key)
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    # Rows of one key share their support; those without a key have only their own segment's and are dealt evenly.
    same = Window.partitionBy(*keys, F.when(~whole, F.xxhash64("call_id", "segment_id", "quote")))
    found = F.coalesce(F.max(F.when(whole, F.col("spilled"))).over(same), F.lit(False))
    return rows.withColumn("supported", F.col("inside") | found).drop("inside", "spilled")


def heard_share(quotes, independent, key="citation_id"):
    """Share of each quote's words that the call's independent transcript contains. `independent` has call_id and text.

    A quote meets its call's vocabulary as one row and is counted there; no row per word is shuffled. A call's vocabulary is one row, as its
    transcript is for the sequence matcher. `key` names the quote, by one column or several; where call_id is one of them, rows of a key are together already."""
    words = F.explode(F.array_distinct(tx.comparable_words(F.col("text")))).alias("word")
    vocabulary = independent.filter(F.col("call_id").isNotNull()).select("call_id", words).groupBy("call_id").agg(F.collect_set("word").alias("__vocabulary"))
    rows = quotes.join(vocabulary, "call_id", "left").withColumn("__words", tx.comparable_words(F.col("quote")))
    rows = rows.withColumn("__heard", F.array_intersect("__words", "__vocabulary"))
    hits = F.size(F.filter("__words", lambda w: F.array_contains("__heard", w)))
    counted = rows.withColumns({"__n": F.when(F.col("__words").isNotNull(), F.size("__words")).otherwise(0),
                                "__hits": F.when(F.col("__heard").isNotNull(), hits).otherwise(0)}).drop("__words", "__vocabulary", "__heard")
    keys = [key] if isinstance(key, str) else list(key)
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    # Quotes of one key share their words; those without a key have no share and are dealt evenly.
    same = Window.partitionBy(*keys, F.when(~whole, F.xxhash64("call_id", "quote")))
    share = F.when(whole, F.sum("__hits").over(same) / F.nullif(F.sum("__n").over(same), F.lit(0)))
    shares = counted.withColumn("share", share).select(*keys, *[c for c in quotes.columns if c not in keys], "share")
    return shares.withColumn("heard", F.coalesce(F.col("share") >= TRIPWIRE_MIN_SHARE, F.lit(True)))


def tripwire(kept, heard, keys, key="citation_id"):
    """Kept claims all of whose quotes were heard, and the held ones. `heard` has the claim keys per quote."""
    verdict = heard.groupBy(*keys).agg(F.every("heard").alias("all_heard"))
    return kept.join(verdict, keys, "left").withColumn("confirmed", F.coalesce("all_heard", F.lit(True))).drop("all_heard")


# ---- fixed value ----
UNCONFIRMED_REASON = "The independent transcript did not hear these words; listen before use"
# ---- end of fixed value ----


def hold_unheard(merged, heard=None, first=None):
    """Merged claims after the tripwire: a kept claim with a quote the independent transcript did not hear is unconfirmed and no longer kept. `heard` has
    call_id, item_pos and heard per quote; a claim without quotes stays. Where `merged` has a row per quote itself, with `heard`, nothing is joined: `first`
    says which row of a claim is the claim's."""
    if heard is None:
        whole = F.col("call_id").isNotNull() & F.col("item_pos").isNotNull()
        lost = whole & ~F.coalesce(F.every("heard").over(Window.partitionBy("call_id", "item_pos")), F.lit(True))
        rows = merged.withColumn("__unheard", lost).filter(first).drop("heard")
    else:
        unheard = heard.filter(~F.col("heard")).select("call_id", "item_pos").distinct().withColumn("__unheard", F.lit(True))
        rows = merged.join(unheard, ["call_id", "item_pos"], "left")
    rows = rows.withColumn("unconfirmed", F.col("kept") & F.coalesce("__unheard", F.lit(False)))
    return rows.withColumn("kept", F.col("kept") & ~F.col("unconfirmed")).drop("__unheard")


def review_entries(held):
    """What a person has to look at: claims the verdicts did not keep, with their tier and reason, and unconfirmed ones with theirs."""
    tier = F.when(F.col("unconfirmed"), "unconfirmed").otherwise(F.col("tier"))
    return held.filter(~F.col("kept")).select("call_id", "collection", "item_pos", tier.alias("tier"), "verdict",
                                              F.when(F.col("unconfirmed"), UNCONFIRMED_REASON).otherwise(F.col("reason")).alias("reason"))


def held_tier_counts(held, by=()):
    """Claims per tier; unconfirmed ones stay counted in the tier their verdict gave them, and are counted once more beside it."""
    return held.groupBy(*by, "tier").agg(F.count(F.lit(1)).alias("claims"), F.count_if("unconfirmed").alias("of_which_unconfirmed"))


def unsupported_places(evidence, segments):
    """Places of evidence (call_id, place, segment_id, quote) whose quote is not in the cited segment, nor runs from it into a neighbour; a citation of
    a segment that is not there is one too."""
    marked = quote_support(evidence, segments, ("call_id", "place"))
    return marked.filter(~F.col("supported")).select("call_id", F.col("place").alias("problem"))


def evidence_rows(items, purposes, quote):
    """(call_id, place, segment_id) of every citation of extractions, with `quote(place key)` as its words: items by `collection[index].key`, the call's
    purpose as purpose_evidence."""
    index = positions_by_size(items, ["call_id", "collection"], ["item_pos"], F.left("item_pos", F.lit(9)), "__n")
    at = F.concat("collection", F.lit("["), (F.col("__n") - 1).cast("string"), F.lit("]."))
    keys = (("evidence", "segment_id"), ("response_evidence", "response_segment_id"), ("resolution_evidence", "resolution_segment_id"))
    cells = F.array(*[F.struct(F.concat(at, F.lit(key)).alias("place"), F.col(column).alias("segment_id"), quote(key).alias("quote")) for key, column in keys])
    rows = index.select("call_id", F.inline(cells)).where("segment_id is not null")
    purpose = purposes.where("purpose_segment_id is not null").select(
        "call_id", F.lit("purpose_evidence").alias("place"), F.col("purpose_segment_id").alias("segment_id"), quote("purpose_evidence").alias("quote"))
    return rows.unionByName(purpose)
