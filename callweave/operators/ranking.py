"""Positions and running values that survive a hot key.

A plain window puts every row of a key into one task. These operators cut each key into ordered buckets: the window
runs per (key, bucket), and the buckets' totals, one small row each, are scanned to give every bucket its start. The
result equals the plain window. The wide rows are shuffled once, by (key, bucket). `by_size` cuts only keys of more than
PLAIN_ROWS rows and gives the others to a plain window: one shuffle and no join where most keys are small.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

# ---- fixed value: rows of a key that one task may hold in a window ----
PLAIN_ROWS = 100_000
# ---- end of fixed value ----


def _start(keys):
    return Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)


def join_back(left, right, keys, how="inner"):
    """Join on keys where null meets null, so no row is lost for a missing key; right's copies of the keys go."""
    names = {k: f"__right_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    same = reduce(and_, [left[k].eqNullSafe(right[n]) for k, n in names.items()])
    return left.join(right, same, how).drop(*names.values())


def by_size(df, keys, plain, cut, counted=None):
    """`plain` over the rows of keys with at most PLAIN_ROWS rows, `cut` over those of larger keys. `counted` has the rows that count (all, if left
    out). Larger keys are at most one in PLAIN_ROWS rows, so their list is broadcast; null is a key like any other."""
    names = {k: f"__right_{k}" for k in keys}
    sizes = (df if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    large = F.broadcast(sizes.filter(F.col("__rows") > PLAIN_ROWS).drop("__rows").withColumnsRenamed(names))
    same = reduce(and_, [df[k].eqNullSafe(large[n]) for k, n in names.items()])
    return plain(df.join(large, same, "left_anti")).unionByName(cut(df.join(large, same, "left_semi")))


def prefix_scan(df, keys, order, bucket, value, out, how="sum", size=None):
    """Running sum or max of `value` along `order` within `keys`, current row included.

    `bucket` must not decrease along `order`. `size` also adds the key's total under that name (sum only)."""
    combine = {"sum": F.sum, "max": F.max}[how]
    keys = list(keys)
    marked = df.withColumn("__bucket", bucket).withColumn("__value", value)
    totals = marked.groupBy(*keys, "__bucket").agg(combine("__value").alias("__total"))
    extra = []
    if size:
        extra = [F.sum("__total").over(Window.partitionBy(*keys)).alias(size)]
    starts = totals.select(*keys, "__bucket", combine("__total").over(_start(keys)).alias("__before"), *extra)
    within = Window.partitionBy(*keys, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    here = combine("__value").over(within)
    result = F.coalesce(F.col("__before"), F.lit(0)) + here if how == "sum" else F.greatest(F.col("__before"), here)
    return join_back(marked, starts, [*keys, "__bucket"]).withColumn(out, result).drop("__bucket", "__value", "__before", "__total")


def positions(df, keys, order, bucket, out="position", size=None):
    """1-based row number along `order` within `keys`; `size` adds the number of rows of the key."""
    return prefix_scan(df, keys, order, bucket, F.lit(1).cast("bigint"), out, "sum", size)


def positions_by_size(df, keys, order, bucket, out="position"):
    """The same for tables of many small keys: one shuffle and no join for keys of ordinary size, buckets for larger ones. The bucket leads the order
    in both: rows without one come first."""
    plain = lambda rows: rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(bucket, *order)).cast("bigint"))
    return by_size(df, keys, plain, lambda rows: positions(rows, keys, order, bucket, out))


def hash_rank(df, hash_column, out, strata=(), digits=3):
    """Exact 1-based rank by a hex hash, over everything or per stratum. The hash's leading digits are the buckets, so
    every task gets an even share and no task sees the whole list."""
    return positions(df, strata, [hash_column], F.left(F.col(hash_column), F.lit(digits)), out) if strata else _global_rank(
        df, hash_column, out, digits)


def _global_rank(df, hash_column, out, digits):
    marked = df.withColumn("__bucket", F.left(F.col(hash_column), F.lit(digits)))
    # At most 16**digits rows, whatever the data: small enough to scan in one task and to broadcast.
    totals = marked.groupBy("__bucket").count()
    starts = totals.select("__bucket", F.sum("count").over(Window.orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1)).alias("__before"))
    within = Window.partitionBy("__bucket").orderBy(hash_column)
    return (join_back(marked, F.broadcast(starts), ["__bucket"])
            .withColumn(out, F.coalesce(F.col("__before"), F.lit(0)) + F.row_number().over(within))
            .drop("__bucket", "__before"))


def neighbour(df, keys, position, columns, offset, prefix):
    """The named columns of the row `offset` positions away, joined on (keys, position): no window."""
    other = df.select(*keys, (F.col(position) - offset).alias(position), *[F.col(c).alias(prefix + c) for c in columns])
    return join_back(df, other, [*keys, position], "left")


def islands(df, keys, position, flagged, bucket, out):
    """Number the runs of consecutive flagged rows of each key from 0; rows outside a run are dropped. Only flagged rows are sorted, by key."""
    keys, kept = list(keys), F.coalesce(flagged, F.lit(False))

    def plain(rows):
        along = Window.partitionBy(*keys).orderBy(position)
        opens = (~F.coalesce(F.lag(position).over(along) == F.col(position) - 1, F.lit(False))).cast("bigint")
        rows = rows.filter(kept).withColumn("__opens", opens)
        return rows.withColumn(out, F.sum("__opens").over(along.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("__opens")

    return by_size(df, keys, plain, lambda rows: _cut_islands(rows, keys, position, flagged, bucket, out), df.filter(kept))


def _cut_islands(df, keys, position, flagged, bucket, out):
    """The runs of large keys. One sort by (key, bucket): a run that goes on across a bucket's border is seen from the buckets' ends, one small row
    each."""
    marked = df.withColumns({"__bucket": bucket, "__flag": F.coalesce(flagged, F.lit(False))})
    here = Window.partitionBy(*keys, "__bucket").orderBy(position)
    goes_on = F.coalesce(F.lag("__flag").over(here) & (F.lag(position).over(here) == F.col(position) - 1), F.lit(False))
    marked = marked.withColumn("__opens", (F.col("__flag") & ~goes_on).cast("bigint"))
    marked = marked.withColumn("__run", F.sum("__opens").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    ends = marked.groupBy(*keys, "__bucket").agg(
        F.sum("__opens").alias("__opened"), F.min_by("__flag", position).alias("__first"), F.min(position).alias("__from"),
        F.max_by("__flag", position).alias("__last"), F.max(position).alias("__to"))
    along = Window.partitionBy(*keys).orderBy("__bucket")
    border = F.coalesce(F.col("__first") & F.lag("__last").over(along) & (F.lag("__to").over(along) == F.col("__from") - 1), F.lit(False)).cast("bigint")
    ends = ends.withColumn("__border", border).withColumn("__new", F.col("__opened") - F.col("__border"))
    base = F.coalesce(F.sum("__new").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = ends.select(*keys, "__bucket", (base - F.col("__border") - 1).alias("__base"))
    numbered = join_back(marked.filter("__flag"), ends, [*keys, "__bucket"])
    return numbered.withColumn(out, F.col("__base") + F.col("__run")).drop("__bucket", "__flag", "__opens", "__run", "__base")
