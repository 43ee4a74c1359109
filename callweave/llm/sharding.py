"""Shards of near-equal bytes by histogram sort (DataFrame functions only).

The sort key of a row is (hash of its text, hash of its id, hash of a number it got when the keys were stored). Each round counts exactly the bytes that lie below evenly spaced
candidate boundaries inside every interval that still holds an unsettled splitter, and narrows the interval; a splitter is
settled when the bytes below it are within the tolerance of its target. Rounds read a stored table of fixed-width keys and
return at most a few thousand sums each. One exchange then deals the rows to shards and numbers them.

Equal texts have equal first keys and lie side by side: a boundary falls between groups of equal texts wherever one meets
the tolerance, and only a group too large for that is cut, by the second key, or by the third where rows repeat.

Cases: a null text has no bytes; a null id hashes like any value; repeated rows, and rows of one text without ids, are told apart by the
third key, so they are cut like others; fewer rows than shards leave shards empty; an empty table gives no rows. Extra columns pass
through `histogram_shards` untouched.
"""

from functools import reduce
from operator import and_, or_

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored

SHARDS = 8
# A splitter may miss its target by this share of a shard.
TOLERANCE = 0.001
# Bits of the key that a round resolves: 2**10 candidate boundaries per open interval.
STEP = 10
# Rows numbered together inside a shard.
SLOT_ROWS = 50_000


def unsigned(hash_column):
    """The hash moved to 0 .. 2**62 - 1, so that boundaries are plain non-negative numbers."""
    return F.shiftrightunsigned(hash_column, 2)


KEYS = ("k1", "k2", "k3")


def splitters(keys, shards=SHARDS, tolerance=TOLERANCE):
    """Boundaries (k1, k2, k3) between shards, from a table of these keys and size. A row belongs to the number of boundaries at or
    below its key."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    cuts, slack = {}, tolerance * total / shards
    # Open intervals: (values of the keys before the one that is divided, prefix of that one, its bits left) -> (bytes below, wanted splitters).
    open_ = {((), 0, 62): (0, list(range(1, shards)))} if total else {}
    while open_:
        spans = list(open_)
        step = [min(STEP, bits) for _, _, bits in spans]
        held = lambda fixed: reduce(and_, [F.col(k) == v for k, v in zip(KEYS, fixed)], F.lit(True))
        inside = F.coalesce(*[F.when(held(fixed) & (F.shiftright(KEYS[len(fixed)], bits) == prefix), F.lit(i)) for i, (fixed, prefix, bits) in enumerate(spans)])
        cell = F.coalesce(*[F.when(F.col("span") == i, F.shiftright(KEYS[len(s[0])], s[2] - step[i])) for i, s in enumerate(spans)])
        ends = [f(k).alias(name + k) for k in KEYS for f, name in ((F.min, "low_"), (F.max, "high_"))]
        sums = (keys.withColumn("span", inside).where(F.col("span").isNotNull())
                .groupBy("span", cell.alias("cell")).agg(F.sum("size").alias("bytes"), *ends).orderBy("span", "cell").collect())
        nxt = {}
        for i, span in enumerate(spans):
            fixed, _, left = span
            below, wanted = open_[span]
            cells = [r for r in sums if r["span"] == i]
            edges = [below]
            for r in cells:
                edges.append(edges[-1] + r["bytes"])
            bits = left - step[i]
            for n in wanted:
                target = total * n / shards
                at = min(range(len(edges)), key=lambda j: abs(edges[j] - target))
                inner = cells[max(j for j in range(len(cells)) if edges[j] <= target)]
                # One value in the key being divided: the next key that has several goes on.
                same = len(fixed)
                while same < len(KEYS) and inner["low_" + KEYS[same]] == inner["high_" + KEYS[same]]:
                    same += 1
                if abs(edges[at] - target) <= slack or same == len(KEYS):  # settled, or a single key that nothing divides
                    value = (cells[at]["cell"] if at < len(cells) else cells[-1]["cell"] + 1) << bits
                    cuts[n] = (*fixed, value, *[0] * (len(KEYS) - len(fixed) - 1))
                else:
                    key = (tuple(inner["low_" + k] for k in KEYS[:same]), 0, 62) if same > len(fixed) else (fixed, inner["cell"], bits)
                    nxt.setdefault(key, (edges[cells.index(inner)], []))[1].append(n)
        open_ = nxt
    return [cuts[n] for n in sorted(cuts)]


def above(cut):
    """Whether a row's keys are at or above a boundary, compared in order."""
    ahead = [reduce(and_, [F.col(k) == v for k, v in zip(KEYS[:i], cut)], F.col(KEYS[i]) > cut[i]) for i in range(len(KEYS))]
    return reduce(or_, ahead, reduce(and_, [F.col(k) == v for k, v in zip(KEYS, cut)]))


def histogram_shards(df, first_key, second_key, size, shards=SHARDS, tolerance=TOLERANCE):
    """df with shard and slot (gapless from 0 in each shard). first_key keeps groups together, second_key divides them, size
    is what is balanced."""
    number = F.xxhash64(F.lit("third"), F.monotonically_increasing_id())
    keyed = df.withColumns({"k1": unsigned(F.xxhash64(first_key)), "k2": unsigned(F.xxhash64(F.lit("second"), second_key)), "k3": unsigned(number), "size": size})
    keyed = stored(keyed, "shard-keys")
    cuts = splitters(keyed.select(*KEYS, "size"), shards, tolerance)
    dealt = keyed.withColumn("shard", sum((F.when(above(cut), 1).otherwise(0) for cut in cuts), F.lit(0)).cast("int"))
    # Numbering: a shard is split evenly by hash, each part numbers its own rows after those of the parts before it.
    parts = max(1, -(-keyed.count() // (shards * SLOT_ROWS)), 32)
    dealt = dealt.withColumn("part", F.pmod("k3", F.lit(parts)))
    before = (dealt.groupBy("shard", "part").count()
              .withColumn("base", F.sum("count").over(W.partitionBy("shard").orderBy("part")) - F.col("count")).drop("count"))
    number = F.row_number().over(W.partitionBy("shard", "part").orderBy(*KEYS))
    return (dealt.withColumn("__n", number).join(F.broadcast(before) if shards * parts <= 100_000 else before, ["shard", "part"])
            .withColumn("slot", F.col("base") + F.col("__n") - 1).drop("__n", "base", "part", *KEYS))


def report(docs):
    """The law `bytes` over whole documents: UTF-8 bytes of the text plus 1."""
    text = F.coalesce("text", F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("bytes"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.xxhash64(text).alias("text_hash"))
    out = histogram_shards(slim, F.col("text_hash"), F.col("doc_id"), F.col("bytes"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
