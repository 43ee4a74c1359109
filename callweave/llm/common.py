"""What several operators of this folder share: reading, stored intermediates, words, size checks."""

import uuid

from pyspark.sql import functions as F

from ..session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A table may be broadcast if it has at most so many (narrow) rows; beyond that the join shuffles.
SMALL_ROWS = 100_000


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df, name):
    """Write df once to the shared checkpoint folder and read it back: later uses cost a scan, and a lost executor costs no
    recomputation."""
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def small(df, rows):
    """A broadcast hint where the counted rows are within SMALL_ROWS; otherwise df as it is, for a shuffled join."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def text_key(text):
    """Two independent 64-bit hashes: rows with one key have one text. Joins by it handle copies, repeated and null ids alike."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))


def ascii_lower(text):
    return F.translate(text, UPPER, LOWER)


def tasks(spark, least=1):
    """Partitions for costly row-wise work: what the session shuffles into, and no fewer than its cores."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


# Slots of a bitmap filter: 1,024 rows of 4 KB at most, whatever is put in.
SLOTS, ROW = 1 << 25, 1 << 15


def _slot(column):
    slot = F.pmod(column, F.lit(SLOTS))
    return F.floor(slot / ROW).alias("__row"), F.pmod(slot, F.lit(ROW)).alias("__bit")


def bitmap(df, column):
    """A table of set slots of a hash column, at most 4 MB: a filter that keeps all that was put in, and some of the rest (the
    more the fuller it is)."""
    return stored(df.select(*_slot(F.col(column))).distinct().groupBy("__row").agg(F.bitmap_construct_agg("__bit").alias("__bits")), "bitmap")


def in_bitmap(df, column, bits):
    """The rows of df whose hash column hits a slot of the bitmap."""
    row, bit = _slot(F.col(column))
    held = df.withColumns({"__row": row, "__bit": bit}).join(F.broadcast(bits), "__row")
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return held.where(F.expr("pow(2, __bit % 8)").cast("int").bitwiseAND(byte) > 0).drop("__row", "__bit", "__bits")
