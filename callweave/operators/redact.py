"""Names out of generated text: dictionary names, spoken names, guessed pronouns and internal terms."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import settle
from .guards import tokens

# ---- fixed values ----
CALENDAR = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
            "jan", "feb", "mar", "apr", "jun", "jul", "aug", "sep", "sept", "oct", "nov", "dec",
            "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
NAME_WORD = r"[a-z]{3,}"
# So many words may be sent to every task.
FEW_WORDS = 100_000
# ---- end of fixed values ----


def _words(df, column, pattern):
    return df.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(0)))).alias("word"))


def name_words(calls, leads, corpus, ordinary=("data",)):
    """(staff, lead) name words; staff are the calls' salespeople and, where that column is there, current owners. A word that also occurs in lower case in the corpus is an ordinary word."""
    common = _words(corpus, "text", r"(?U)\b[a-z]{3,}\b").distinct()
    known = lambda df, column: _words(df.select(F.lower(F.coalesce(F.col(column), F.lit(""))).alias("n")), "n", NAME_WORD).distinct().filter(
        ~F.col("word").isin(*ordinary)).join(common, "word", "left_anti")
    people = [calls.select(F.col(c).alias("name")) for c in ("salesperson", "current_owner") if c in calls.columns]
    return known(reduce(DataFrame.union, people).distinct(), "name"), known(leads, "lead_name")


def own_words(leads):
    """Each lead's own name words."""
    return tokens(leads, ["lead"], F.col("lead_name"), NAME_WORD).distinct()


def known_words(words, *lists):
    """The words that any of the name lists has, each once: the corpus's distinct words are put together in every task before they meet the lists."""
    names = reduce(DataFrame.unionByName, [names.select("word") for names in lists]).distinct()
    return settle(words.select("word").distinct().join(names, "word"))


def redact(texts, own, staff, lead_names, key="text_id"):
    """Cleaned texts (key, lead, text). Only words of the corpus that are names somewhere go on from a text: while these are few, which is counted, the
    others are left out where the text stands, and no row per word is moved. Each text's hits come back as one map, so only texts with names are
    touched."""
    ready = texts.withColumn("text", tx.drop_spoken_names(F.col("text")))
    words = tokens(ready, [key, "lead"], F.col("text"), r"(?U)\b[a-z]{3,}\b")
    known = known_words(words, own, staff, lead_names)
    words = words.join(F.broadcast(known) if known.count() <= FEW_WORDS else known, "word")
    hits = (words.join(own.withColumn("own", F.lit("the lead")), ["lead", "word"], "left")
            .join(staff.withColumn("staff", F.lit("the counsellor")), "word", "left")
            .join(lead_names.withColumn("other", F.lit("another person")), "word", "left"))
    swap = F.coalesce("own", "staff", "other")
    maps = hits.filter(swap.isNotNull()).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("word", swap.alias("swap")))).alias("swaps"))
    rows = ready.join(maps, key, "left")
    pieces = F.regexp_extract_all("text", F.lit(r"(?U)\w+|\W+"), F.lit(0))
    replaced = F.array_join(F.transform(pieces, lambda w: F.when(w.rlike("^[A-Za-z]{3,}$"), F.coalesce(
        F.try_element_at("swaps", F.lower(w)), w)).otherwise(w)), "")
    named = F.when(F.col("swaps").isNull(), F.col("text")).otherwise(replaced)
    return rows.withColumn("text", tx.wording(tx.neutral(named))).drop("swaps")


def possible_names(texts):
    """Capitalised words that occur nowhere in lower case and are not calendar words: for a person to scan."""
    capitals = _words(texts, "text", r"(?U)\b[A-Z][a-z]{2,}\b").distinct().withColumn("lower", F.lower("word"))
    lower = _words(texts, "text", r"(?U)\b[a-z]{3,}\b").distinct().withColumnRenamed("word", "lower")
    return capitals.filter(~F.col("lower").isin(*CALENDAR)).join(lower, "lower", "left_anti").select("word")
