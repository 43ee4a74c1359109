"""Sinks: JSON, guarded CSV, the ledger, transcripts, write-once datasets and multi-table publication."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import dataset_digest
from ..functions.text import clock, safe_cell


# Times keep their microseconds in text.
TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_json(df, path):
    """Replace a JSON dataset; Spark's committer makes the job's output appear as a whole."""
    df.write.mode("overwrite").options(**TIMES).json(path)


def append_ledger(events, path):
    events.write.mode("append").options(**TIMES).json(path)


def append_batch(events, path, batch):
    """Append one batch to the ledger under its own name: run again, it replaces itself, so a retried batch is no second one."""
    events.write.mode("overwrite").options(**TIMES).json(f"{path}/batch={batch}")


def write_corpus(df, path, key, body, buckets=256):
    """A corpus of one JSON document per entity as lines `{"id": ..., "document": ...}` in `buckets` folders by the key's hash: no file per entity,
    and one entity is read from one folder. A retry replaces the folders as a whole."""
    rows = df.select(bucket_of(key, buckets).alias("bucket"), F.to_json(F.struct(F.col(key).alias("id"), F.try_parse_json(F.col(body)).alias("document"))).alias("value"))
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").text(path)


def bucket_of(key, buckets):
    return F.pmod(F.xxhash64(F.col(key) if isinstance(key, str) else key), F.lit(buckets)).cast("int")


def safe_table(df):
    """Cells fit for a spreadsheet: nested values as JSON, null as empty text, formulas defused. Numbers stay numbers."""
    cells = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            cells.append(safe_cell(F.to_json(column)).alias(field.name))
        elif isinstance(field.dataType, T.StringType):
            cells.append(safe_cell(column).alias(field.name))
        else:
            cells.append(column)
    return df.select(*cells)


def write_csv(df, path):
    """Header, formula-safe cells; one file per partition."""
    safe_table(df).write.mode("overwrite").options(**TIMES).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def transcript_line(role):
    """`[mm:ss] ROLE: text` over start and text."""
    return F.concat(F.lit("["), clock(F.col("start")), F.lit("] "), role, F.lit(": "), "text")


def write_transcripts(lines, path):
    """Readable transcripts, one folder per lead. `lines` has lead, call_id, segment_id, role, start, text; rows are
    sorted within tasks so a call's lines stay together and in order."""
    role = F.when(F.col("role") == "agent", "COUNSELLOR").when(F.col("role") == "prospect", "LEAD").otherwise("SPEAKER")
    ordered = lines.repartition("lead", "call_id").sortWithinPartitions("lead", "call_id", "segment_id")
    ordered.select("lead", F.concat(F.col("call_id"), F.lit(" "), transcript_line(role)).alias("value")).write.mode("overwrite").partitionBy("lead").text(path)


def write_transcript_buckets(lines, path, buckets=256):
    """Readable transcripts of any number of leads in `buckets` folders by the lead's hash, `lead call [mm:ss] ROLE: text` a line; within a file a
    call's lines stand together and in order."""
    role = F.when(F.col("role") == "agent", "COUNSELLOR").when(F.col("role") == "prospect", "LEAD").otherwise("SPEAKER")
    rows = lines.withColumn("bucket", bucket_of("lead", buckets)).repartition("bucket", "lead").sortWithinPartitions("bucket", "lead", "call_id", "segment_id")
    said = F.concat_ws(" ", "lead", "call_id", transcript_line(role))
    rows.select("bucket", said.alias("value")).write.mode("overwrite").partitionBy("bucket").text(path)


def write_once(df, path, manifest=None):
    """Write a frozen dataset, or check that a rebuild equals it. Returns its digest; a different rebuild is refused."""
    row = dataset_digest(df).first()
    if manifest is None:
        df.write.mode("errorifexists").parquet(path)
    elif manifest != row["sha256"]:
        raise ValueError("The dataset is already fixed and the rebuilt one differs; investigate before replacing it")
    return row["sha256"]


def publish(tables, path, guards=()):
    """Write several tables of one run, JSON and CSV, after every guard frame proved empty."""
    for name, violations in guards:
        shown = violations.limit(5).collect()
        if shown:
            raise ValueError(f"{name}: " + "; ".join(str(r.asDict()) for r in shown))
    for name, df in tables.items():
        write_json(df, f"{path}/{name}.json")
        write_csv(df, f"{path}/{name}.csv")
