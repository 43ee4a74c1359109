"""Connected components of a link table by repeated contraction."""

from pyspark.sql import functions as F

from .common import stored


def components(links, left="a", right="b"):
    """(node, component) for every node of links; equal component means connected.

    Each round moves every node to its smallest neighbour (or itself) and contracts the links; nodes are first renamed by a
    bijective hash, so that chains shrink by a constant share per round whatever their order. Only counts reach the driver.
    The mapping of all nodes is a stored table, joined by key once per round; sizes are sums of map-side minima, so a hub
    with any number of links is one aggregated row per task."""
    named = links.select(F.xxhash64(left).alias("u"), F.xxhash64(right).alias("v"))
    edges = stored(named.where("u <> v").distinct(), "links")
    ids = links.select(F.explode(F.array(left, right)).alias("node")).distinct()
    labels = stored(ids.select("node", F.xxhash64("node").alias("component")), "labels")
    while not edges.isEmpty():
        ends = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        least = stored(ends.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("at"), F.least("u", "v").alias("to")), "least")
        moved = least.where("at <> to")
        labels = stored(labels.join(moved, labels["component"] == moved["at"], "left")
                        .select("node", F.coalesce("to", "component").alias("component")), "labels")
        edges = stored(edges.join(least.select(F.col("at").alias("u"), F.col("to").alias("x")), "u")
                       .join(least.select(F.col("at").alias("v"), F.col("to").alias("y")), "v")
                       .where("x <> y").select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct(), "links")
    return labels
