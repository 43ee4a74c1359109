"""Checks that return violation rows. An empty result means the checked rows may be used."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions import text as tx


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def _rules(df, keep, rules):
    """Rows of `keep` plus problem for every rule whose condition is true; one scan whatever the number of rules."""
    cells = F.array_compact(F.array(*[F.when(condition, F.lit(problem) if isinstance(problem, str) else problem)
                                      for condition, problem in rules]))
    return df.withColumn("problem", F.explode(cells)).select(*keep, "problem")


def evidence_problems(evidence, calls, lines):
    """Citations of a coding against its lead's calls and their lines."""
    known = calls.select("call_id", F.col("lead").alias("call_lead"), F.to_date("created_on").cast("string").alias("call_date"))
    rows = evidence.join(known, (evidence["call_id"] == known["call_id"]) & (evidence["lead"] == known["call_lead"]), "left").drop(known["call_id"])
    spoken = lines.select("call_id", "segment_id", F.col("start").alias("line_start"), F.col("text").alias("line_text"))
    rows = rows.join(spoken, ["call_id", "segment_id"], "left")
    foreign, missing = F.col("call_lead").isNull(), F.col("line_text").isNull()
    quote = tx.norm(F.col("quote"))
    return _rules(rows, ["lead", "evidence_no", "place"], [
        (foreign, "call is not this lead's"), (~foreign & (F.col("date") != F.col("call_date")), "date differs from the call date"),
        (~foreign & missing, "segment not in call"),
        (~foreign & ~missing & (F.abs(F.col("line_start") - F.col("start_seconds")) > 2), "start differs from the segment start"),
        (~foreign & ~missing & ((quote == "") | ~F.contains(tx.norm(F.col("line_text")), quote)), "quote is not verbatim"),
        (~foreign & ~missing & (tx.word_count(F.col("quote")) > 15), "quote longer than 15 words")])


def wording_problems(texts):
    """Wording of client texts, long form (lead, place, text)."""
    text = F.col("text")
    hit = lambda rx, what: (text.rlike(rx), F.concat(F.lit(what + " "), tx.found(text, rx)))
    talk = F.col("place").startswith("what_to_say") | (F.col("place") == "next_action")
    return _rules(texts.filter(text.isNotNull()), ["lead", "place"], [
        hit(tx.BANNED, "internal word"), hit(tx.PRONOUNS, "gendered pronoun"), hit(tx.CONTACT, "contact detail"),
        ((F.col("place") == "next_action") & text.rlike(tx.RELATIVE_TIME), F.concat(F.lit("relative timing "), tx.found(text, tx.RELATIVE_TIME))),
        (talk & tx.offer_without_condition(text), "a discount, offer or trial must be conditional on current approval"),
        (F.col("place").startswith("swot") & (tx.word_count(text) > 25), "over 25 words"),
        ((F.col("place") == "next_action") & (tx.word_count(text) > 50), "over 50 words")])


def tokens(df, keys, text, pattern, out="word"):
    """Distinct matches of a pattern per row, one row each."""
    return df.select(*keys, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0)))).alias(out))


def name_problems(texts, names):
    """Words of a lead's client texts that are name words of that lead's calls. `names` has lead and word."""
    words = tokens(texts, ["lead", "place"], F.col("text"), r"[a-z]{3,}")
    return words.join(names.select("lead", "word").distinct(), ["lead", "word"]).select(
        "lead", "place", F.concat(F.lit("personal name "), "word").alias("problem"))


def stance_problems(codings):
    """Consistency of a coded stance. Needs live_call_id, live_date and call_matches (the live call exists on that date)."""
    c = F.col
    silent = c("stance").isin("none", "recording_unusable")
    has_live = c("live_call_id").isNotNull()
    return _rules(codings, ["lead"], [
        ((c("stance") == "conditional_commitment") & (c("condition").isNull() | c("condition_can_be_met").isNull() | c("condition_reason").isNull()),
         "a conditional commitment needs condition, condition_can_be_met and condition_reason"),
        (silent & has_live, "a last live conversation is given for a lead nobody reached"),
        (~silent & (c("stance") != "declined") & ~has_live, "a stance other than none needs the last live conversation"),
        (has_live & ~F.coalesce(c("call_matches"), F.lit(False)), "last_live_conversation does not match one of the lead's calls"),
        ((c("target_value") == "outside_target") & (c("target_reason").isNull() | ~c("has_target_evidence")), "outside_target needs a reason and evidence"),
        (c("status_needed") & (c("status_reason").isNull() | ~c("has_status_evidence")), "a status check needs a reason and evidence")])


def unread_calls(calls, read):
    """Leads whose list of read calls differs from their calls, either way, with both counts."""
    pairs = calls.select("lead", "call_id").withColumn("have", F.lit(1)).join(
        read.select("lead", "call_id").withColumn("said", F.lit(1)), ["lead", "call_id"], "full_outer")
    counts = pairs.groupBy("lead").agg(F.count_if(F.col("said").isNull()).alias("not_read"), F.count_if(F.col("have").isNull()).alias("not_theirs"))
    return counts.filter((F.col("not_read") > 0) | (F.col("not_theirs") > 0))


def published_problems(rows, keys, columns, patterns):
    """Cells of a published table that match an internal pattern, long form (keys, column, match)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    long = rows.select(*keys, F.inline(cells))
    hit = F.coalesce(*[tx.found(F.col("value"), p) for p in patterns])
    return long.withColumn("match", hit).filter(F.col("match").isNotNull()).drop("value")


def text_flags(texts, text="text"):
    """One row per text with a flag per wording guard; whole texts, one scan. The text is lowered once, which lets the
    patterns run case-sensitively, several times faster than folding case in every one."""
    rows = texts.withColumn("__low", F.lower(F.col(text)))
    hit = lambda rx: F.col("__low").rlike(tx.for_lowered(rx))
    return rows.select("doc_id", hit(tx.BANNED).alias("banned"), hit(tx.PRONOUNS).alias("pronoun"), hit(tx.CONTACT).alias("contact"),
                       hit(tx.RELATIVE_TIME).alias("relative_time"), (hit(tx.OFFER) & ~hit(tx.CONDITIONAL)).alias("offer"), hit(tx.INTERNAL_TEXT).alias("internal"))


def secret_scan(files, host, path="path", content="content"):
    """Files that must not be published, with the first reason: private place or type, recording link, key, secret."""
    p, t = F.col(path), F.col(content)
    private = F.regexp_extract(p, r"^([^/]*)/", 1).isin(*tx.PRIVATE_FOLDERS) | F.lower(F.regexp_extract(p, r"(\.[^./]*)$", 1)).isin(*tx.PRIVATE_SUFFIXES)
    name = F.regexp_extract(p, r"([^/]*)$", 1)
    env = name.startswith(".env") & (name != ".env.example")
    link = t.rlike("https://" + host.replace(".", "[.]") + r"/\S+")
    reason = (F.when(private | env, "private file").when(link, "recording link").when(t.rlike(tx.KEY_PATTERNS), "api key")
              .when(t.rlike(tx.SECRET_ASSIGNMENT), "secret"))
    return files.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(path, "reason")


def raise_on(violations, what):
    """Fail a job when a violations frame is not empty; shows a few rows and collects no more than those."""
    shown = violations.limit(5).collect()
    if shown:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in shown))
    return violations
