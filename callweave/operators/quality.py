"""Human review: templates, freshness of reviews, accuracy and the audit sample."""

from pyspark.sql import functions as F

from ..functions.keys import digest
from ..functions.stats import wilson
from .align import word_edits, word_error_rate
from .small import beside

# ---- fixed values ----
REVIEW_FIELDS = ("reference_text", "reviewed_silence", "reviewer", "reviewed_at", "reference_value", "extraction_correct", "missed_information")
QA_FIELDS = ("conversation_type", "goal", "current_role", "experience", "course", "timeline", "budget", "signals", "objections", "pitches",
             "next_action", "summary")
# ---- end of fixed values ----


def latest_prior(prior, keys, order):
    """The last earlier row per key, as an aggregate (no window over a popular key)."""
    rest = [c for c in prior.columns if c not in keys]
    return prior.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("x")).select(*keys, "x.*")


def merge_reviews(template, prior, keys, order):
    """Template rows with the reviewer's fields of the last earlier row of the same key; other fields stay the template's."""
    fields = [f for f in REVIEW_FIELDS if f in prior.columns]
    last = latest_prior(prior, keys, order).select(*keys, *[F.col(f).alias("__" + f) for f in fields], F.lit(True).alias("__had"))
    joined = template.join(last, keys, "left")
    kept = [c for c in template.columns if c not in fields]
    empty = lambda f: F.col(f) if f in template.columns else F.lit(None).cast("string")
    return joined.select(*kept, *[F.when(F.col("__had"), F.col("__" + f)).otherwise(empty(f)).alias(f) for f in fields])


def superseded(template, prior, keys, order):
    """Last earlier rows whose key the new template no longer has; archived, never applied."""
    return latest_prior(prior, keys, order).join(template.select(*keys), keys, "left_anti")


def fresh_reviews(reviews, current, keys, order):
    """Marks each review row used, stale (its artifact changed) or duplicate (not the first fresh row of its key).

    `current` has call_id and fingerprint of held-out calls; `keys` identify a review."""
    rows = reviews.join(current.select("call_id", F.col("fingerprint").alias("__now")), "call_id", "left")
    fresh = F.coalesce(F.col("artifact_fingerprint") == F.col("__now"), F.lit(False))
    rows = rows.withColumn("__fresh", fresh)
    first = rows.filter("__fresh").groupBy(*keys).agg(F.min(order).alias("__first"))
    rows = rows.join(first, keys, "left")
    state = F.when(~F.col("__fresh"), "stale").when(F.col(order) == F.col("__first"), "used").otherwise("duplicate")
    return rows.withColumn("state", state).drop("__now", "__fresh", "__first")


def filled(column):
    return F.coalesce(F.col(column), F.lit("")) != ""


def field_accuracy(marked):
    """Accuracy over signed yes / no verdicts of used rows; null when nothing is reviewed."""
    verdict = F.lower(F.trim(F.coalesce("extraction_correct", F.lit(""))))
    scored = (F.col("state") == "used") & filled("reviewer") & filled("reviewed_at") & verdict.isin("yes", "no")
    return marked.agg(F.count_if(scored).alias("reviewed_fields"), F.count_if(F.col("state") == "used").alias("available_field_rows"),
                      F.count_if(F.col("state") != "used").alias("ignored_rows"),
                      (F.count_if(scored & (verdict == "yes")) / F.nullif(F.count_if(scored), F.lit(0))).alias("field_accuracy"))


def scorable_references(marked):
    """Signed reference rows that can be scored: words, or confirmed silence, but not both."""
    ref = F.trim(F.coalesce("reference_text", F.lit("")))
    silent = F.lower(F.coalesce("reviewed_silence", F.lit(""))) == "yes"
    ok = (F.col("state") == "used") & filled("reviewer") & filled("reviewed_at") & ((ref != "") != silent)
    return marked.filter(ok).withColumns({"reference": ref, "silent": silent})


def validation_status(sample):
    """Signed verdicts on the audit sample, precision with its Wilson interval, and whether every row is signed."""
    verdict = F.lower(F.trim(F.coalesce("correct", F.lit(""))))
    signed = filled("reviewer") & filled("reviewed_at") & verdict.isin("yes", "no")
    counts = sample.agg(F.count_if(signed).alias("audit_reviewed"), F.count_if(signed & (verdict == "yes")).alias("audit_correct"),
                        F.count(F.lit(1)).alias("audit_sample"))
    low, high = wilson(F.col("audit_correct"), F.col("audit_reviewed"))
    return counts.withColumns({"audit_precision": F.col("audit_correct") / F.nullif(F.col("audit_reviewed"), F.lit(0)), "audit_low": low,
                               "audit_high": high, "complete": (F.col("audit_reviewed") == F.col("audit_sample")) & (F.col("audit_sample") > 0)})


def audit_sample(items, calls, segments, k=100, seed="claim-audit-v1"):
    """k claims of the given calls with the smallest digests of [seed, call, claim], with the cited words and their time."""
    label = F.replace(F.col("label"), F.lit("_"), F.lit(" "))
    claim = F.concat(F.expr("left(collection, length(collection) - 1)"), F.lit(" ("), label, F.lit("): "), "text")
    rows = items.withColumn("claim", claim).join(calls.select("call_id", "created_on"), "call_id").join(
        segments.select("call_id", "segment_id", "start", F.col("text").alias("quote")), ["call_id", "segment_id"])
    whole = F.floor("start").cast("bigint")
    stamp = F.format_string("%d:%02d", F.floor(whole / 60), whole % 60)
    rows = rows.withColumn("draw_hash", digest(seed, F.col("call_id"), F.col("claim")))
    return rows.orderBy("draw_hash", "item_pos").limit(k).select(
        "call_id", "item_pos", "claim", F.to_date("created_on").cast("string").alias("date"), stamp.alias("timestamp"), "quote", "draw_hash")


def qa_sheet(current, fields=QA_FIELDS):
    """One row to review per held-out call and field. `current` has call_id and fingerprint."""
    return current.select("call_id", F.col("fingerprint").alias("artifact_fingerprint"), F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"))


def transcription_sheet(current):
    """One row to transcribe per held-out call with a transcript, over the whole recording; no system's words are shown. `current` has lead_alias,
    call_id, fingerprint and duration_seconds."""
    empty = [F.lit("").alias(c) for c in ("reference_text", "reviewed_silence", "reviewer", "reviewed_at")]
    return current.select("lead_alias", "call_id", F.col("fingerprint").alias("artifact_fingerprint"), F.lit(0).alias("start_seconds"),
                          F.col("duration_seconds").alias("end_seconds"), *empty)


def evaluate(holdout, transcripts, extractions, text_rows, field_rows, order):
    """One row: what the signed reviews say about the held-out calls now.

    holdout: call_id. transcripts: call_id, fingerprint, text. extractions: call_id, fingerprint. A review row counts if its call is held out,
    its artifact is still the current one and it is the first such row of its key; references count if signed, with words or confirmed silence;
    field verdicts if signed. Rates are null where nothing is reviewed."""
    current = lambda artifacts: artifacts.join(holdout, "call_id", "left_semi")
    texts = fresh_reviews(text_rows, current(transcripts).select("call_id", "fingerprint"), ["call_id"], order)
    fields = fresh_reviews(field_rows, current(extractions).select("call_id", "fingerprint"), ["call_id", "field"], order)
    scored = scorable_references(texts).select("call_id", "reference", "silent").join(transcripts.select("call_id", F.coalesce("text", F.lit("")).alias("hypothesis")), "call_id")
    edits = word_edits(scored)
    words = word_error_rate(edits).select("wer", "reference_words", "substitutions", "deletions", "insertions")
    counts = edits.agg(F.count(F.lit(1)).alias("reviewed_calls"), F.count_if("silent").alias("reviewed_silent_calls"))
    ignored = texts.agg(F.count_if(F.col("state") != "used").alias("__texts"))
    parts = [holdout.agg(F.countDistinct("call_id").alias("expected_holdout_calls")), counts, words, field_accuracy(fields), ignored]
    one = parts[0]
    for part in parts[1:]:
        one = beside(one, part)
    return one.withColumn("ignored_rows", F.col("ignored_rows") + F.col("__texts")).drop("__texts")
