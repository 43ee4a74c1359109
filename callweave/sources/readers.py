"""Sources: call tables, JSON documents, per-entity artifact folders, the event ledger and review sheets."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ingest import require_columns
from .sinks import bucket_of

LEDGER_SCHEMA = ("event_id string, recorded_at timestamp_ntz, stage string, call_id string, status string, system string, model string, "
                 "wall_seconds double, external_cost_inr double, audio_seconds double, input_tokens bigint, output_tokens bigint")


def call_table(spark, path, required=(), schema=None):
    """A call export (Parquet or CSV by suffix); refuses a table without the required columns."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.option("header", True).csv(path) if path.rstrip("/").endswith(".csv") else reader.parquet(path)
    return require_columns(df, required) if required else df


def json_document(spark, path, schema):
    """Whole-file JSON documents with an explicit schema; a broken document is an error, not a null row."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", True).json(path)


def artifacts(spark, folder, schema):
    """One JSON document per call: adds call_id from the file name. Convert to Parquet once; small files scan badly."""
    df = spark.read.schema(schema).option("multiLine", True).json(folder).withColumn("file", F.col("_metadata.file_name"))
    return df.withColumn("artifact_id", F.regexp_extract("file", r"^(.*)\.json$", 1)).drop("file")


def corpus(spark, path, schema, key=None, buckets=256):
    """Documents that `sinks.write_corpus` wrote: id and the fields of `schema`, which is closed only by what it names. With a key, only that entity's
    folder is read."""
    rows = spark.read.schema("value string, bucket int").text(path)
    if key is not None:
        rows = rows.where(F.col("bucket") == bucket_of(F.lit(key), buckets))
    rows = rows.select(F.from_json("value", f"id string, document struct<{schema}>").alias("x")).select("x.id", "x.document.*")
    return rows if key is None else rows.where(F.col("id") == key)


def transcript(spark, path, lead, buckets=256):
    """One lead's lines of bucketed transcripts, in the order of their files."""
    rows = spark.read.schema("value string, bucket int").text(path).where(F.col("bucket") == bucket_of(F.lit(lead), buckets))
    return rows.where(F.col("value").startswith(f"{lead} ")).select("value")


def ledger(spark, path, schema=LEDGER_SCHEMA):
    """The append-only event ledger (JSON lines), appended to as files or as batches."""
    return spark.read.schema(schema).json(path).select(*T.StructType.fromDDL(schema).names)


def ledger_stream(spark, path, schema=LEDGER_SCHEMA, files_per_trigger=None):
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).json(path)


def review_sheet(spark, path):
    """A CSV sheet people edit: header row, all text, byte-order mark stripped from the first column's name."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    first = df.columns[0]
    return df.withColumnRenamed(first, first.lstrip("﻿"))


def union_rows(frames):
    """Frames with different columns as one; columns are the ordered union and missing cells are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
