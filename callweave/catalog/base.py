"""Registration of checked queries: a Spark callable and, where SQL can say it, the same question for DuckDB."""

from pyspark.sql import functions as F

from ..session import tune
from ..sources.bindings import Tables

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    """Register `fn(tables) -> DataFrame` as a query over a folder of tables."""
    def register(fn):
        def run(spark, folder):
            return fn(Tables(tune(spark), folder))
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def rounded(df, digits=6):
    """Round double columns so that summation order cannot show."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])
