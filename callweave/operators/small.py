"""Helpers for frames whose size is fixed by the code: one-row results and constant tables."""

from pyspark.sql import functions as F


def beside(left, right):
    """Put two one-row results next to each other."""
    return left.withColumn("__one", F.lit(1)).join(F.broadcast(right.withColumn("__one", F.lit(1))), "__one").drop("__one")


def constants(spark, rows, schema):
    """A literal table (labels, rates, quotas): its size is the length of the list in the code."""
    return spark.createDataFrame(rows, schema)


def case_of(column, mapping, default=None):
    """CASE over a constant mapping."""
    expr = None
    for key, value in mapping.items():
        expr = F.when(column == key, F.lit(value)) if expr is None else expr.when(column == key, F.lit(value))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def unpivot_struct(df, keep, pairs, label, value):
    """Long form: one row per (name, column) pair."""
    cells = F.array(*[F.struct(F.lit(name).alias(label), column.alias(value)) for name, column in pairs])
    return df.select(*keep, F.inline(cells))


def with_scalar(df, one_row):
    """Give every row the columns of a one-row frame."""
    return df.withColumn("__one", F.lit(1)).join(F.broadcast(one_row.withColumn("__one", F.lit(1))), "__one").drop("__one")
