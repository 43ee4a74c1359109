"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two halves. Two fingerprints that differ in at most three bits differ in at most one bit in one of
the halves, so each fingerprint looks up, in the table of either half, its own half and the 32 halves one bit away. What it
meets is verified on all 64 bits. Equal fingerprints are one entry; copies never meet each other.

Cases: null and wordless texts have fingerprint zero, which links like any other; a text of one or two words is one shingle;
repeated rows keep a row each; a null id takes its component's smallest id; an empty table gives an empty result. Extra
columns stay untouched.
"""

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from .common import stored
from .components import components

SHINGLE, SEED, MOST_BITS = 3, 42, 3
# Shingles whose bits are unpacked at a time.
BLOCK = 1 << 15


def fingerprint(text, size=SHINGLE):
    """64 bits of a text: bit i is set if it is set in over half of the hashes of its word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both are ASCII only on bytes
    if not words:
        return 0
    if len(words) <= size:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(size)))), len(words) - size + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = hashes[at:at + BLOCK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


@pandas_udf(LongType())
def simhash(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def near_links(prints, column="fingerprint", most=MOST_BITS):
    """(a, b), a < b: the pairs of distinct fingerprints that differ in 1 to `most` (at most 3) bits."""
    if most > 3:
        raise ValueError("two halves of radius one prove distances up to 3")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(32)])
    low, high = F.col(column).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(column, 32)
    halves = prints.select(column, F.posexplode(F.array(low, high)).alias("half", "value"))
    table = halves.withColumnRenamed(column, "b")
    tried = halves.select(F.col(column).alias("a"), "half", F.explode(F.transform(flips, lambda m: F.col("value").bitwiseXOR(m))).alias("value"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most)
    return tried.join(table, ["half", "value"]).where(close).select("a", "b").distinct()


def groups(docs, doc_id, text):
    """Stored (id, fingerprint) rows of docs, and (fingerprint, component, component_id): which ones are reachable
    over near links, and the smallest id of all that are."""
    rows = stored(docs.select(doc_id, simhash(F.col(text)).alias("fingerprint")), "fingerprints")
    prints = stored(rows.groupBy("fingerprint").agg(F.min(doc_id).alias("least")), "prints")
    links = stored(near_links(prints), "near-links")
    held = prints.join(components(links).withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    held = held.select("fingerprint", "least", F.coalesce("component", F.xxhash64("fingerprint")).alias("component"))
    firsts = held.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows, stored(held.join(firsts, "component").select("fingerprint", "component", "component_id"), "components")


def near_duplicates(docs, doc_id="doc_id", text="text"):
    """docs' ids with fingerprint (long) and component_id."""
    rows, named = groups(docs, doc_id, text)
    return rows.join(named.drop("component"), "fingerprint")


def first_of_group(docs, doc_id="doc_id", text="text"):
    """One row of docs per component, as it came: that of the smallest id. Where several rows of a component share this id, or
    none has an id, one of them."""
    _, named = groups(docs, doc_id, text)
    named = named.select(*[F.col(c).alias(f"__{c}") for c in named.columns])
    rows = docs.withColumn("__fingerprint", simhash(F.col(text)))
    first = rows.join(named, "__fingerprint").where(F.col(doc_id).eqNullSafe(F.col("__component_id")))
    return first.dropDuplicates(["__component"]).select(*docs.columns)


def report(docs):
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
