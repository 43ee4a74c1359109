"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

Slots of one block of words each are numbered 0, 1, 2 ...; slot i has the point frac(i * golden ratio) and belongs to the source in
whose share of [0, 1) the point falls. Any stretch of slots so holds every source nearly in proportion to its target. The r-th slot
of a source reads the r-th block of its shuffled words, from the start again after the last block. A source stops in the block that
reaches its target; slots beyond that stay empty, and the few that the points left out follow at the end. So every source is read for
its target to the word, and no word more than CAP times.

Shuffling is an order by md5 of id and text: reruns agree. Positions in a source's shuffled words are running sums by leading hash
digits, so a hot source is spread over all tasks; rows of one id and text (all of them take the same place but for their number) are counted
first and numbered afterwards.

Cases: a null, empty or blank text has size 0 and nothing is taken from it; a null source is a source, the last; a source without words has
target 0; a null id is hashed as no text; repeated rows are documents each; a document of any length is cut only between slots; an empty table
gives no rows; extra columns are not read.
"""

from pyspark.sql import functions as F

from ..operators.ranking import positions, prefix_scan
from .common import small, stored, tasks

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, CAP = (1, 2, 3), 3
# Words of a block.
BLOCK = 512
# Points are multiples of 2**-40; the golden ratio's fractional part is the odd number below.
POINTS, GOLDEN, HALF = 1 << 40, 679_535_556_991, 1 << 20
# Leading bits of a point by which slots meet the sources' shares.
CELL_BITS = 12
# Rows of one hash prefix, at most by expectation; slots ranked together and made by one task; equal rows made by one task.
ROWS_TOGETHER, SLOTS_TOGETHER, SLOTS_MADE, COPIES_TOGETHER = 50_000, 1 << 16, 1 << 22, 10_000


def sources_of(rows, weights=WEIGHTS):
    """(source, no, weight, source_size): sources numbered by code point, null last, with weights in turn."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    spark = rows.sparkSession
    ordered = sums.repartitionByRange(tasks(spark), F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    numbered = positions(stored(ordered, "sources"), [], [F.col("source").asc_nulls_last()], F.col("part"), "no").withColumn("no", F.col("no") - 1)
    turn = F.array(*map(F.lit, weights))
    return stored(numbered.select("source", "no", F.element_at(turn, (F.col("no") % len(weights) + 1).cast("int")).alias("weight"), "source_size"), "numbered-sources")


def targets(sources, cap=CAP):
    """sources with the target of each: its share by weight of all words, at most cap times its own; what that leaves is shared again."""
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (total or 0) / (weight or 1), 0
    while total:
        over = F.col("source_size") * cap < F.col("weight") * F.lit(level)
        n, held, weighed = sources.where(over).agg(F.count("*"), F.sum("source_size") * cap, F.sum("weight")).first()
        if n == capped:
            break
        level, capped = (total - held) / (weight - weighed), n
    return sources.withColumn("target", F.least((F.col("source_size") * cap).cast("double"), F.col("weight") * F.lit(float(level)))), total or 0


def points(slot):
    """floor(2**40 * frac(slot * golden ratio)), without leaving 64 bits."""
    high, low = F.shiftright(slot, 20), F.pmod(slot, F.lit(HALF))
    return F.pmod(low * GOLDEN + F.pmod(high * GOLDEN, F.lit(HALF)) * HALF, F.lit(POINTS))


def schedule(shares, total, block=BLOCK):
    """(slot, no, start, n_words, block): which words of which source a slot reads. `start` counts in the source's endless repetition. Slots
    that no source needs are left out."""
    shares = shares.withColumns({"need": F.floor(F.col("target") + 0.5), "blocks": F.ceil(F.col("source_size") / block)})
    unit = F.floor(F.col("target") / float(total or 1) * POINTS)
    placed = prefix_scan(shares.withColumn("part", F.floor(F.col("no") / SLOTS_TOGETHER)), [], ["no"], F.col("part"), unit, "high").drop("part")
    placed = placed.withColumns({"low": F.col("high") - unit, "slots": F.when(F.col("source_size") > 0, F.expr("need div source_size * blocks") + F.ceil(
        F.expr("need % source_size") / block)).otherwise(0)})
    placed = stored(placed, "shares")
    count = placed.count()
    width = POINTS >> CELL_BITS
    cells = (placed.where("high > low").withColumn("cell", F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))))
             .select("no", "low", "high", "cell"))
    n_slots = -(-total // block)
    spark = shares.sparkSession
    slots = spark.range(0, n_slots, 1, max(tasks(spark), n_slots // SLOTS_MADE)).select(F.col("id").alias("slot"))
    slots = slots.withColumn("point", points(F.col("slot"))).withColumn("cell", F.expr(f"point div {width}"))
    drawn = slots.join(small(cells, count + (1 << CELL_BITS)), "cell").where("low <= point and point < high").select("slot", "no")
    ranked = stored(positions(drawn, ["no"], ["slot"], F.floor(F.col("slot") / SLOTS_TOGETHER), "rank").withColumn("rank", F.col("rank") - 1), "slots")
    had = ranked.groupBy("no").agg(F.count("*").alias("had"))
    # What the points left out comes at the end, a round of all sources at a time.
    rest = (placed.join(had, "no", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < slots")
            .select(F.explode(F.sequence(F.col("had"), F.col("slots") - 1)).alias("rank"), "no", "had")
            .select((F.lit(n_slots) + (F.col("rank") - F.col("had")) * count + F.col("no")).alias("slot"), "no", "rank"))
    used = ranked.select("slot", "no", "rank").unionByName(rest).join(small(placed.select("no", "source_size", "need", "blocks"), count), "no")
    at = F.expr(f"rank div blocks * source_size + rank % blocks * {block}")
    used = used.where("blocks > 0").withColumns({"start": at, "block": F.expr("rank % blocks")})
    length = F.least(F.lit(block), F.col("source_size") - F.col("block") * block, F.col("need") - F.col("start"))
    return used.withColumn("n_words", length).where("n_words > 0").select("slot", "no", "start", "n_words", "block")


def placed_rows(rows):
    """rows of (no, doc_id, size, key) with `start`, the words of the source before them in shuffled order."""
    together = rows.groupBy("no", "key", "doc_id", "size").agg(F.count("*").alias("copies"))
    together = stored(together, "distinct-rows")
    counts = together.agg(F.count("*").alias("n"), F.max("copies").alias("most")).first()
    digits = 2
    while counts["n"] / 16 ** digits > ROWS_TOGETHER:
        digits += 1
    ends = prefix_scan(together, ["no"], ["key", "doc_id"], F.left("key", F.lit(digits)), F.col("size") * F.col("copies"), "end")
    first = F.col("end") - F.col("size") * F.col("copies")
    starts = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_TOGETHER).cast("long"))
    chunks = ends.select("no", "doc_id", "size", "copies", first.alias("first"), F.explode(starts).alias("at"))
    if (counts["most"] or 0) > COPIES_TOGETHER:
        chunks = chunks.repartition(tasks(rows.sparkSession), "no", "first", "at")
    each = F.explode(F.sequence(F.col("at"), F.least(F.col("at") + COPIES_TOGETHER, F.col("copies")) - 1)).alias("copy")
    return chunks.select("no", "doc_id", "size", "first", each).select("no", "doc_id", "size", "copy", (F.col("first") + F.col("copy") * F.col("size")).alias("start"))


def mixed(docs, doc_id="doc_id", text="text", source="source", block=BLOCK, cap=CAP, weights=WEIGHTS):
    """(documents, shares, pieces). documents: (no, doc_id, size, copy, start), one row per document. shares: the sources with their targets.
    pieces: (slot, place, no, start, doc_id, doc_word, n_words): at word `place` of a slot, n_words words of a document from its doc_word on."""
    value = F.coalesce(F.col(text), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), value).cast("binary"))
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.regexp_count(value, F.lit(WORD)).cast("long").alias("size"), key.alias("key")), "sizes")
    numbered = sources_of(rows, weights)
    shares, total = targets(numbered, cap)
    shares = stored(shares, "targets")
    count = shares.count()
    names = small(shares.select(F.col("source").alias("name"), "no"), count)
    held = stored(placed_rows(rows.join(names, rows["source"].eqNullSafe(F.col("name"))).select("no", "doc_id", "size", "key")), "placed")
    parts = held.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
    slots = schedule(shares, total, block).select("slot", "no", "block", F.col("n_words").alias("reads"))
    begin = F.greatest(F.col("start"), F.col("block") * block)
    over = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("reads")) - begin
    pieces = (parts.join(slots, ["no", "block"]).withColumn("n_words", over).where("n_words > 0")
              .select("slot", (begin - F.col("block") * block).alias("place"), "no", "start", "doc_id", (begin - F.col("start")).alias("doc_word"), "n_words"))
    return held, shares, pieces


def report(docs):
    held, shares, pieces = mixed(docs.select("doc_id", "text", "source"))
    count = shares.count()
    taken = pieces.groupBy("no", "start").agg(F.sum("n_words").alias("taken"))
    empty = held.where("size = 0").select("no", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    full = held.where("size > 0").join(taken, ["no", "start"], "left").select("no", "doc_id", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    return (full.unionByName(empty).join(small(shares.select("no", "source_size", "target"), count), "no")
            .select("doc_id", "size", "source_size", "target", "taken"))
