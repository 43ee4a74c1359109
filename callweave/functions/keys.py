"""Identity: canonical JSON text, digests and keys, as Column expressions."""

from functools import reduce

from pyspark.sql import functions as F

LANES = 5  # a 64-digit sha256 gives five 12-digit (48-bit) lanes


def _unit(code):
    return F.concat(F.lit("\\u"), code)


def json_text(value):
    """A JSON string literal in ASCII: quotes and backslashes escaped, control and other characters as \\uXXXX by UTF-16 code unit (two for those beyond
    the basic plane), but for the five short forms. Plain ASCII takes the short way."""
    text = value.cast("string")
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    short = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}

    def one(char):
        code = F.lower(F.hex(F.encode(char, "UTF-16BE")))
        units = F.concat(_unit(F.left(code, F.lit(4))), F.when(F.length(code) > 4, _unit(F.substring(code, 5, 4))).otherwise(F.lit("")))
        rule = F.when(char.rlike(r"\A[\x20-\x7E]\z"), char)
        for raw, form in short.items():
            rule = rule.when(char == raw, F.lit(form))
        return rule.otherwise(units)

    every = F.array_join(F.transform(F.regexp_extract_all(escaped, F.lit(r"(?s)."), F.lit(0)), one), "")
    return F.concat(F.lit('"'), F.when(escaped.rlike(r"[^\x20-\x7E]"), every).otherwise(escaped), F.lit('"'))


def json_list(*values):
    """`["a", "b", 3]`: comma and space; ints and ("number", column) stay bare, other literals and columns are quoted."""
    parts = []
    for value in values:
        if isinstance(value, int):
            parts.append(F.lit(str(value)))
        elif isinstance(value, str):
            parts.append(json_text(F.lit(value)))
        elif isinstance(value, tuple):  # ("number", column)
            parts.append(value[1].cast("string"))
        else:
            parts.append(json_text(value))
    joined = reduce(lambda a, b: F.concat(a, F.lit(", "), b), parts)
    return F.concat(F.lit("["), joined, F.lit("]"))


def digest(*values):
    """sha256 (hex) of the JSON list of the values."""
    return F.sha2(json_list(*values), 256)


def call_key(url):
    """Stable call id: C and the first 16 digits of the digest of the JSON-quoted url."""
    return F.concat(F.lit("C"), F.left(F.sha2(json_text(url), 256), F.lit(16)))


def row_digest(df, columns=None):
    """sha256 of the row as a JSON list of its columns in name order; null is written null."""
    columns = sorted(columns or df.columns)
    return F.sha2(F.concat(F.lit("["), F.concat_ws(", ", *[
        F.coalesce(json_text(F.col(f"`{c}`")), F.lit("null")) for c in columns]), F.lit("]")), 256)


def dataset_digest(df, columns=None):
    """One row (rows, sha256) that changes when any row changes.

    The row digests are added lane by lane, so the result needs no sort and no single task: each task adds up its own
    rows. Rows carry their own keys and positions, hence order changes that matter change the digest."""
    lanes = df.select(row_digest(df, columns).alias("h"))
    sums = [F.sum(F.conv(F.substring("h", 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")).alias(f"l{i}") for i in range(LANES)]
    total = lanes.agg(F.count(F.lit(1)).alias("rows"), *sums)
    text = F.concat_ws("-", F.col("rows").cast("string"), *[F.coalesce(F.col(f"l{i}"), F.lit(0)).cast("string") for i in range(LANES)])
    return total.select("rows", F.sha2(text, 256).alias("sha256"))
