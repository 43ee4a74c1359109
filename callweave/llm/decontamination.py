"""Benchmark decontamination by a positional inverted index of the training text (DataFrame functions only).

The index holds postings (text, term, position). For every benchmark window the corpus is searched through the window's two
rarest terms: their lists, shifted by the terms' offsets in the window, are intersected, and what is left is compared word
by word with the text. Postings are stored for those rarest terms only; every occurrence of them in the corpus is kept.

Cases: null or wordless texts have no words and no hits; null item texts have no windows; an item shorter than a window is
one window; repeated rows and copies are found through the text's key and each keep their own output row; an empty
benchmark gives rows without hits. Only the named columns are read, so other columns cannot clash.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import ascii_lower, small, stored, text_key

WINDOW = 10
# Lists that are intersected before the comparison with the text.
LISTS = 2
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    """Lower-cased (A-Z) runs of digits, letters and characters beyond ASCII."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def item_windows(items, item_id, text, size=WINDOW):
    """(item, window): the distinct windows of each item, as their words joined by a space."""
    words = items.select(F.col(item_id).alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (words.select("item", F.explode(F.transform(starts, lambda s: F.array_join(F.slice("words", s, size), " "))).alias("window"))
            .distinct())


def window_terms(windows):
    """(window, term, offset) of distinct windows."""
    return windows.select("window", F.posexplode(F.split("window", " ")).alias("offset", "term"))


def term_counts(texts, terms, n_terms):
    """(term, n): occurrences in the whole corpus of each of the given terms."""
    found = texts.select(F.explode("words").alias("term")).join(small(terms, n_terms), "term").groupBy("term").count()
    return terms.join(found, "term", "left").select("term", F.coalesce("count", F.lit(0)).alias("n"))


def postings(texts, terms, n_terms):
    """(key, term, position) of the given terms: the stored positional index."""
    return (texts.select("key", F.posexplode("words").alias("position", "term")).join(small(terms, n_terms), "term"))


def occurrences(docs, text, items, item_id, item_text, size=WINDOW, slop=0):
    """Where benchmark windows occur: one row per text key with `found`, an array of (start, length, window, kind).

    kind is "phrase" for exact matches. With slop > 0 there are also "near" rows: the window's two rarest terms stand within
    slop words of their distance in the window, and all but at most slop of its words stand in that stretch. Also returns
    the item windows, for joining items to matches."""
    pairs = stored(item_windows(items, item_id, item_text, size), "windows")
    windows = pairs.select("window").distinct()
    parts = stored(window_terms(windows), "window-terms")
    terms = stored(parts.select("term").distinct(), "terms")
    texts = docs.select(text_key(F.col(text)).alias("key"), words_of(F.col(text)).alias("words"))
    counts = term_counts(texts, terms, terms.count())
    # A window with a term that occurs nowhere cannot occur; among the others the rarest terms lead.
    rarity = W.partitionBy("window").orderBy("n", "offset")
    ranked = (parts.join(counts, "term")
              .withColumn("least", F.min("n").over(W.partitionBy("window")))
              .withColumn("parts", F.count(F.lit(1)).over(W.partitionBy("window")))
              .withColumn("rank", F.row_number().over(rarity)))
    leads = stored(ranked.where((F.col("rank") <= LISTS) & ((F.col("least") > 0) | F.lit(slop > 0)))
                   .select("window", F.xxhash64("window").alias("wid"), "term", "offset", "rank",
                           F.least("parts", F.lit(LISTS)).alias("needed"), F.col("parts").cast("int").alias("length")), "leads")
    lead_terms = leads.select("term").distinct()
    n_leads = leads.count()
    index = stored(postings(texts, lead_terms, n_leads), "postings")
    listed = index.join(small(leads.select("wid", "term", "offset", "rank", "needed", "length"), n_leads), "term")
    if slop:
        shifts = F.when(F.col("rank") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(-slop), F.lit(slop)))
        listed = listed.withColumn("shift", F.explode(shifts))
    else:
        listed = listed.withColumn("shift", F.lit(0))
    met = (listed.withColumn("start", F.col("position") - F.col("offset") + F.col("shift")).where(F.col("start") >= -slop)
           .groupBy("key", "wid", "start")
           .agg(F.max(F.when(F.col("rank") == 1, 1).otherwise(0)).alias("first"),
                F.max(F.when(F.col("rank") == 2, 1).otherwise(0)).alias("second"),
                F.max("needed").alias("needed"), F.max("length").alias("length"))
           .where(F.col("first") + F.col("second") >= F.col("needed")))
    phrases = leads.where(F.col("rank") == 1).select("wid", "window")
    lists = (met.join(small(phrases, n_leads), "wid")
             .groupBy("key").agg(F.collect_list(F.struct("start", "length", "window")).alias("met")))
    return lists, pairs


def verified(words, met, slop=0):
    """The (start, length, window, kind) of met that the words bear out."""
    def kind(m):
        exact = (m["start"] >= 0) & (F.array_join(F.slice(words, F.greatest(m["start"], F.lit(0)) + 1, m["length"]), " ") == m["window"])
        if not slop:
            return F.when(exact, F.lit("phrase"))
        stretch = F.slice(words, F.greatest(m["start"] - slop, F.lit(0)) + 1, m["length"] + 2 * slop)
        asked = F.array_distinct(F.split(m["window"], " "))
        near = F.size(F.array_intersect(asked, stretch)) >= F.size(asked) - slop
        return F.when(exact, F.lit("phrase")).when(near, F.lit("near"))

    tried = F.transform(met, lambda m: F.struct(m["start"].alias("start"), m["length"].alias("length"), m["window"].alias("window"),
                                                kind(m).alias("kind")))
    return F.filter(tried, lambda m: m["kind"].isNotNull())


def covered(found):
    """How many words the (start, length) stretches cover together."""
    spans = F.array_sort(F.transform(found, lambda m: F.struct(m["start"].alias("s"), (m["start"] + m["length"]).alias("e"))))
    state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc, x):
        return F.struct(F.greatest(acc["end"], x["e"]).alias("end"),
                        (acc["n"] + F.greatest(x["e"] - F.greatest(x["s"], acc["end"]), F.lit(0))).alias("n"))

    return F.aggregate(spans, state, step)["n"]


def matches(docs, text, items, item_id="item_id", item_text="text", size=WINDOW, slop=0):
    """docs with n_words, found (array of start, length, window, kind) and items (the ids met by phrases, a sorted array of
    strings). One row per input row."""
    lists, pairs = occurrences(docs, text, items, item_id, item_text, size, slop)
    rows = docs.withColumn("__key", text_key(F.col(text)))
    lists = lists.withColumnsRenamed({"key": "__key", "met": "__met"})
    none = F.array().cast("array<struct<start:int,length:int,window:string,kind:string>>")
    held = (rows.join(lists, "__key", "left").withColumn("__words", words_of(F.col(text)))
            .withColumn("n_words", F.size("__words").cast("long"))
            .withColumn("found", F.coalesce(verified(F.col("__words"), F.col("__met"), slop), none)).drop("__words", "__met"))
    held = stored(held.drop(text), "found") if text in held.columns else held
    hit = (held.where(F.size("found") > 0)
           .select("__key", F.explode(F.array_distinct(F.transform(F.filter("found", lambda m: m["kind"] == "phrase"), lambda m: m["window"]))).alias("window"))
           .distinct())
    named = (hit.join(pairs, "window").groupBy("__key")
             .agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")))
    return (held.join(named, "__key", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
            .drop("__key"))


def report(docs, items, doc_id="doc_id", text="text", item_id="item_id", item_text="text"):
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated."""
    met = matches(docs.select(doc_id, text), text, items, item_id, item_text)
    n_hit = covered(F.filter("found", lambda m: m["kind"] == "phrase"))
    return met.select(doc_id, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs, items, text="text", item_id="item_id", item_text="text"):
    """docs without the rows that hold a benchmark phrase; columns as they came."""
    lists, _ = occurrences(docs, text, items, item_id, item_text)
    rows = docs.withColumn("__key", text_key(F.col(text)))
    held = rows.join(lists.withColumnsRenamed({"key": "__key", "met": "__met"}), "__key", "left")
    hits = F.size(F.coalesce(verified(words_of(F.col(text)), F.col("__met")), F.array().cast("array<struct<start:int,length:int,window:string,kind:string>>")))
    return held.where(hits == 0).select(*docs.columns)
