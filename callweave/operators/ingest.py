"""Call-table validation: every row is accepted or rejected with its first failing rule."""

from pyspark.sql import functions as F

from ..functions.keys import call_key
from .journeys import outcomes

# ---- fixed values: columns a call table must have ----
REQUIRED = ("duration_text", "status", "recording_url", "salesperson", "created_on", "lead_raw", "flag")
# ---- end of fixed values ----


def require_columns(df, required=REQUIRED):
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def duration_seconds(text):
    """`1h:2m:3s` -> 3723; null when malformed or when minutes or seconds reach 60."""
    parts = F.split(text, "[hms]:?")
    h, m, s = (F.get(parts, F.lit(i)).try_cast("bigint") for i in range(3))
    return F.when(text.rlike(r"^\d+h:0*[0-5]?\dm:0*[0-5]?\ds$"), h * 3600 + m * 60 + s)


def lead_key(raw):
    """Trimmed text; whole-valued numbers lose their `.0`; null for a fraction, a boolean or nothing."""
    text = F.trim(raw)
    whole = F.regexp_extract(text, r"^([+-]?\d+)\.0*$", 1)
    fractional = text.rlike(r"^[+-]?\d*\.\d*[1-9]\d*$")
    return F.when(fractional | F.lower(text).isin("true", "false"), None).when(whole != "", whole).otherwise(text)


def approved_url(url, host):
    """(https and the exact host, no user info and no port but 443), as two patterns over the text."""
    name = host.replace(".", "[.]")
    return url.rlike(rf"(?i)^https://([^/?#]*@)?{name}(:\d+)?([/?#]|$)"), url.rlike(rf"(?i)^https://{name}(:443)?([/?#]|$)")


def validate(raw, host):
    """Adds lead, url, seconds, created_at, and `reason` (null for accepted rows).

    The duplicate rule looks at accepted rows only: a row is a duplicate when an earlier row with its url passes every
    other rule. The earliest such row per url is an aggregate joined back, so a url repeated very often is a skewed join
    and not one window partition."""
    require_columns(raw)
    columns = [c for c in raw.columns if c not in ("source_row", "is_formula")]
    rows = raw.na.drop("all", subset=columns)
    url = F.trim(F.coalesce(F.col("recording_url"), F.lit("")))
    good_host, good_authority = approved_url(url, host)
    rows = rows.withColumns({"url": url, "lead": lead_key(F.col("lead_raw")), "seconds": duration_seconds(F.col("duration_text")),
                             "created_at": F.col("created_on").try_cast("timestamp_ntz")})
    early = (F.when(F.col("is_formula"), "Formula in source record; requires review")
             .when(F.col("lead_raw").isNull() | F.lower(F.col("lead_raw")).isin("true", "false"), "Missing or invalid Lead Number")
             .when(F.col("lead").isNull(), "Fractional Lead Number")
             .when(~good_host, "Recording URL outside the approved HTTPS source host")
             .when(~good_authority, "Unexpected recording URL credentials or port"))
    late = (F.when(F.col("created_at").isNull(), "CreatedOn is not a date")
            .when(F.col("seconds").isNull(), "Invalid call duration")
            .when(F.col("seconds") <= 0, "Non-positive duration")
            .when(~F.coalesce(F.col("flag"), F.lit("")).isin("", "Yes", "No"), "Unrecognised conversion flag"))
    rows = rows.withColumns({"__early": early, "__late": late})
    first = rows.filter(F.col("__early").isNull() & F.col("__late").isNull()).groupBy("url").agg(F.min("source_row").alias("__first"))
    rows = rows.join(first, "url", "left")
    duplicate = F.when(F.col("source_row") > F.col("__first"), "Duplicate recording URL")
    return rows.withColumn("reason", F.coalesce("__early", duplicate, "__late")).drop("__early", "__late", "__first")


def split(validated):
    """(accepted calls with their key, rejects)."""
    accepted = validated.filter(F.col("reason").isNull()).select(
        call_key(F.col("url")).alias("call_id"), "lead", "source_row", F.col("url").alias("recording_url"),
        F.col("seconds").alias("duration_seconds"), F.col("created_at").alias("created_on"), "status", "salesperson",
        F.nullif(F.col("flag"), F.lit("")).alias("flag"))
    return accepted, validated.filter(F.col("reason").isNotNull()).select("source_row", "reason")


def import_audit(calls):
    """Headline figures and count tables of a call table, long form (metric, key, value)."""
    figures = calls.agg(F.count(F.lit(1)).cast("double").alias("calls"), F.countDistinct("lead").cast("double").alias("leads"),
                        (F.sum("duration_seconds") / 60).alias("audio_minutes"))
    figures = figures.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), F.col(m).alias("value"))
                                                for m in ("calls", "leads", "audio_minutes")])))
    leads = outcomes(calls)
    tables = [(leads.groupBy(F.col("outcome").alias("key")), "lead_outcomes"), (calls.groupBy(F.col("status").alias("key")), "status"),
              (leads.groupBy(F.col("calls").cast("string").alias("key")), "calls_per_lead")]
    for grouped, metric in tables:
        figures = figures.unionByName(grouped.agg(F.count(F.lit(1)).cast("double").alias("value")).withColumn("metric", F.lit(metric)))
    span = calls.agg(F.min("created_on").alias("lo"), F.max("created_on").alias("hi")).select(
        F.inline(F.array(F.struct(F.lit("first_call").alias("metric"), F.col("lo").cast("string").alias("key"), F.lit(0.0).alias("value")),
                         F.struct(F.lit("last_call").alias("metric"), F.col("hi").cast("string").alias("key"), F.lit(0.0).alias("value")))))
    return figures.unionByName(span)
