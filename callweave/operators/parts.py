"""Ordered text of a group, in parts of a fixed number of lines, so that no row and no task grows with the group."""

from pyspark.sql import functions as F

from .ranking import positions

LINES_PER_PART = 200


def text_parts(df, keys, order, bucket, line, out, separator="\n", lines=LINES_PER_PART, position=None):
    """One row per (keys, part): the lines in order, joined. Groups of up to `lines` lines have the single part 1."""
    rows = df if position else positions(df, keys, order, bucket, "__pos")
    pos = F.col(position or "__pos")
    rows = rows.select(*keys, (F.floor((pos - 1) / lines) + 1).alias("part"), F.struct(pos.alias("p"), line.alias("line")).alias("x"))
    return rows.groupBy(*keys, "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]), separator).alias(out))
