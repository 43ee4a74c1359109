"""Line deduplication by a deletion-neighbourhood join (DataFrame functions only).

Two lines are near if one word edit (insert, delete or replace) or none turns one into the other. A line goes if an equal
line, or a near one, stands earlier in the corpus, in the order of (document id, line number). Equal lines go whatever their length, and in
scripts without spaces too; lines of fewer than MIN_WORDS words are too short for an edit and are near to none but equal ones.

Equal lines are one class. A class can only have a near one if the two share their first or their last half; a bitmap of
shared halves leaves all others out, so that only the text of candidates is moved. Candidates emit, for every word, a hashed
key of the words without it, and one of all words; keys that two lines have are joined again and hashed exactly. Lines with equal
exact keys are near: replaced words give equal keys at the same position, an inserted word gives the key of the shorter line.
Per key only the earliest line matters, so keys are aggregated, never paired, and a family of thousands of near lines costs
one row per line. The edit distance to that earliest line is verified on the words.

Words are separated by spaces; their case counts.

Cases: a null text has no lines and stays null; lines of nothing but spaces stay; null ids come first in the order; rows with equal id and
text are one document, each keeps its row; an empty table gives no rows; extra columns pass through.
"""

from pyspark.sql import functions as F

from .common import bitmap, in_bitmap, stored

MIN_WORDS = 5


def line_words(line):
    return F.filter(F.split(line, " "), lambda w: w != "")


def halves(words):
    """Hashed first and last halves: a line of n words meets lines of n - 1, n and n + 1 words."""
    n = F.size(words)

    def keys(m):
        head = F.floor(m / 2).cast("int")
        return [F.xxhash64(m, F.lit("head"), F.slice(words, 1, head)), F.xxhash64(m, F.lit("tail"), F.slice(words, n - (m - head) + 1, m - head))]

    return F.array(*keys(n), *keys(n + 1))


def split_lines(docs, doc_id, text):
    """(at, line) of every line; `at` is its place: id, text hash and line number."""
    lines = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("doc"), F.posexplode(F.split(text, "\n")).alias("no", "line"))
    return lines.select(F.struct("id", "doc", "no").alias("at"), "line")


def variant_keys(lines):
    """(at, gap, key): a hash of the line's words, all of them (gap -1) and without the word at each gap. It is an exclusive or
    over words, so lines that differ by one deletion share it, and few others do."""
    word = F.transform("words", lambda w: F.xxhash64(w))
    total = F.aggregate(F.col("hashes"), F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(h))
    rows = lines.select("at", word.alias("hashes")).select("at", "hashes", total.alias("total"), F.size("hashes").alias("n"))
    cut = F.transform("hashes", lambda h, i: F.struct(i.alias("gap"), F.xxhash64(F.col("n") - 1, F.col("total").bitwiseXOR(h)).alias("key")))
    whole = F.array(F.struct(F.lit(-1).alias("gap"), F.xxhash64("n", "total").alias("key")))
    return rows.select("at", F.explode(F.concat(whole, cut)).alias("v")).select("at", "v.gap", "v.key")


def one_edit(a, b):
    """Whether at most one word edit turns a into b."""
    short, long_ = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    spot = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    first = F.array_position(spot, True)  # 1-based; 0 where one is the other's start
    # What follows the first differing word of the longer line must end both lines.
    rest = long_ - first
    tail = lambda w: F.slice(w, F.greatest(F.size(w) - rest + 1, F.lit(1)), rest)
    return (long_ - short <= 1) & ((first == 0) | (tail(a) == tail(b)))


def candidates(docs, doc_id, text, rows):
    """(at, words) of the first line of each class that may have a near one; rows has at, a, b and halves."""
    half = rows.select("a", F.explode("halves").alias("half"))
    shared = half.groupBy("half").agg(F.min("a").alias("x"), F.max("a").alias("y")).where("x <> y").select("half")
    near = in_bitmap(rows.select("at", "a", "b", F.explode("halves").alias("half")), "half", bitmap(shared, "half"))
    firsts = stored(near.groupBy("a", "b").agg(F.min("at").alias("at")).select("at", F.xxhash64("at").alias("of")), "line-candidates")
    lines = in_bitmap(split_lines(docs, doc_id, text).withColumn("of", F.xxhash64("at")), "of", bitmap(firsts, "of"))
    # Repeated rows share their places.
    found = lines.select("at", "line").join(firsts.select("at"), "at").dropDuplicates(["at"])
    return stored(found.select("at", line_words(F.col("line")).alias("words")), "candidate-lines")


def earlier_near(held):
    """Places of the lines in held (at, words) that have a near line before them."""
    keys = variant_keys(held)
    of = F.xxhash64("at")
    live = keys.groupBy("key").agg(F.min(of).alias("x"), F.max(of).alias("y")).where("x <> y").select("key")
    gaps = keys.join(live, "key").select("at", "gap")
    without = F.when(F.col("gap") < 0, F.col("words")).otherwise(
        F.concat(F.slice("words", 1, F.greatest("gap", F.lit(0))), F.slice("words", F.col("gap") + 2, F.size("words"))))
    variants = stored(gaps.join(held, "at").select("at", "gap", F.xxhash64(F.size(without), without).alias("key")), "line-variants")
    # The earliest line per key: at one gap for replaced words, whole or with any gap for inserted ones.
    first = variants.where("gap >= 0").groupBy("key", "gap").agg(F.min("at").alias("least"), F.max("at").alias("last"))
    replaced = first.where(F.col("least") < F.col("last")).select("key", "gap", "least")
    by_key = variants.groupBy("key").agg(F.min(F.when(F.col("gap") < 0, F.col("at"))).alias("whole"), F.min(F.when(F.col("gap") >= 0, F.col("at"))).alias("cut"))
    inserted = by_key.where(F.col("whole").isNotNull() & F.col("cut").isNotNull())
    a = variants.join(replaced, ["key", "gap"]).select("at", "least")
    b = variants.join(inserted, "key").select("at", F.when(F.col("gap") < 0, F.col("cut")).otherwise(F.col("whole")).alias("least"))
    pairs = a.unionByName(b).where(F.col("least") < F.col("at")).distinct()
    words = held.select(F.col("at").alias("least"), F.col("words").alias("other"))
    return (pairs.join(held, "at").join(words, "least").where(one_edit(F.col("words"), F.col("other")))
            .select("at").distinct())


def repeated_lines(docs, doc_id="doc_id", text="text"):
    """(id, doc, gone): per document (id and text hash) the numbers of the lines that go."""
    lines = split_lines(docs, doc_id, text).select("at", line_words(F.col("line")).alias("words")).where(F.size("words") > 0)
    near = F.when(F.size("words") >= MIN_WORDS, halves(F.col("words"))).otherwise(F.array().cast("array<bigint>"))
    rows = stored(lines.select("at", F.xxhash64("words").alias("a"), F.xxhash64(F.lit("second"), "words").alias("b"), near.alias("halves")), "lines")
    near = earlier_near(candidates(docs, doc_id, text, rows)).withColumn("near", F.lit(True))
    classes = rows.groupBy("a", "b").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    held = (classes.join(near.withColumnRenamed("at", "first"), "first", "left")
            .where((F.col("first") != F.col("last")) | F.col("near").isNotNull()))
    gone = rows.select("at", "a", "b").join(held, ["a", "b"]).where((F.col("at") != F.col("first")) | F.col("near").isNotNull())
    return gone.groupBy("at.id", "at.doc").agg(F.collect_set("at.no").alias("gone"))


def cleaned(docs, doc_id="doc_id", text="text"):
    """docs with __gone (numbers of the lines that go, null for none) and __text (what is left)."""
    gone = repeated_lines(docs, doc_id, text).withColumnsRenamed({"id": "__id", "doc": "__doc", "gone": "__gone"})
    rows = docs.withColumn("__hash", F.xxhash64(text))
    held = rows.join(gone, rows[doc_id].eqNullSafe(gone["__id"]) & (rows["__hash"] == gone["__doc"]), "left")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("__gone", i)), "\n")
    return held.withColumn("__text", F.when(F.col("__gone").isNull(), F.col(text)).otherwise(left)).drop("__hash", "__id", "__doc")


def without_repeats(docs, doc_id="doc_id", text="text", n_chars=None):
    """docs, as they came, with the lines that go taken out of the text; a column n_chars follows the changed texts."""
    changed = {text: F.col("__text")}
    if n_chars:
        kind = docs.schema[n_chars].dataType
        changed[n_chars] = F.when(F.col("__gone").isNotNull(), F.char_length("__text").cast(kind)).otherwise(F.col(n_chars))
    return cleaned(docs, doc_id, text).withColumns(changed).select(*docs.columns)


def report(docs):
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    return cleaned(docs.select("doc_id", "text")).select("doc_id", F.col("__text").alias("text"), lines.alias("n_lines"),
                                                         F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"))
