"""Exact top-k inner-product search over an impact-ordered index, score at a time.

Vectors are quantised to integers. Rows and queries are dealt into blocks by hash; every pair of a row block and a query block is
one unit of work. In it, postings are segments of rows by quantised impact, the power of two in |v|; segments are processed in
order of falling impact for all queries of the block together. What is still unprocessed of a row has a known length, so by Cauchy-Schwarz the row's score lies within
(rest of the row) * (length of the query) of what has been added up. Rows whose upper bound is below the k-th lower bound
are proven out; processing stops only when few others are left, and those are rescored exactly. The k best of each unit are merged
with a rank limit.

Cases: vectors that are null, hold a null or a non-finite component, or have a null id take no part; shorter vectors count
as zero in the components they lack; repeated query rows are one query, repeated rows are candidates each; equal scores go
by smaller id; with fewer than k candidates all are returned; an empty table gives no rows.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored

TOP, SCALE, EVERY = 20, 64, 20
ROWS_IN_BLOCK, QUERIES_IN_BLOCK = 4096, 1024
# Processing stops once so many possible members per query are left (on average), or all impacts are done.
FEW = 64


def quantised(df, vec_id, embedding, scale=SCALE):
    """(id, v): floor(scale * x) of each component x."""
    sound = F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.coalesce(sound, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("id"), F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def matrix(vectors, width):
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


class ImpactIndex:
    """Postings of a block of rows by falling impact: per power of two the rows with such components, and these components."""

    def __init__(self, rows, kind):
        self.squares = (rows ** 2).sum(1)
        level = np.frexp(np.abs(rows))[1]  # 0 for zeros, n for 2**(n-1) <= |v| < 2**n
        self.segments = []
        for n in range(int(level.max(initial=0)), 0, -1):
            at = np.flatnonzero((level == n).any(1))
            self.segments.append((at, np.where(level[at] == n, rows[at], 0).astype(kind)))

    def candidates(self, queries, own, k):
        """(row, query) pairs that may be among a query's k best; own is a mask of pairs that may not."""
        lengths = np.sqrt((queries.astype(float) ** 2).sum(1))
        scores = np.zeros((len(self.squares), len(queries)), queries.dtype)
        scores[own] = -np.inf
        rest = self.squares.copy()
        for at, postings in self.segments[:-1]:
            scores[at] += postings @ queries.T
            rest[at] -= (postings.astype(float) ** 2).sum(1)
            # A proof needs the unprocessed rest to be short; before that it is not worth trying.
            if rest.sum() * 8 <= self.squares.sum() and (found := self.possible(scores, rest, lengths, k)) is not None:
                return found
        for at, postings in self.segments[-1:]:
            scores[at] += postings @ queries.T
        return self.possible(scores, np.zeros(len(rest)), lengths, k, always=True)

    def possible(self, scores, rest, lengths, k, always=False):
        """The pairs not proven out, or None while they are many. The slack has a margin for rounding."""
        slack = (np.sqrt(np.maximum(rest, 0))[:, None] * lengths + (rest > 0)[:, None] * 1.0).astype(scores.dtype)
        if len(scores) > k:
            low = scores if always else scores - slack
            least = np.partition(low, len(scores) - k, axis=0)[len(scores) - k]
        else:
            least = np.full(len(lengths), -np.inf, scores.dtype)
        open_ = (scores + slack >= least) & (scores > -np.inf)
        return np.nonzero(open_) if always or open_.sum() <= FEW * len(lengths) else None


def block_search(rows, queries, k):
    """The k best (query, qhash, vec_id, score) of a block, from pandas frames (id, v) and (id, qhash, v)."""
    width = max(max(map(len, rows["v"])), max(map(len, queries["v"])))
    x, q = matrix(rows["v"], width), matrix(queries["v"], width)
    ids, asked = rows["id"].to_numpy(), queries["id"].to_numpy()
    # Single precision holds these whole numbers exactly, with room for the bounds, up to 2**20.
    kind = np.float32 if np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * width < 1 << 20 else np.float64
    at, of = ImpactIndex(x, kind).candidates(q.astype(kind), ids[:, None] == asked, k)
    scores = np.concatenate([np.einsum("ij,ij->i", x[at[i:i + 65536]], q[of[i:i + 65536]]) for i in range(0, len(at), 65536)] or [np.zeros(0)])
    order = np.lexsort((ids[at], -scores, of))
    at, of, scores = at[order], of[order], scores[order]
    first = np.r_[0, np.flatnonzero(np.diff(of)) + 1] if len(of) else np.zeros(0, int)
    place = np.arange(len(of)) - np.repeat(first, np.diff(np.r_[first, len(of)]))
    keep = place < k
    return pd.DataFrame({"query_id": asked[of[keep]], "qhash": queries["qhash"].to_numpy()[of[keep]], "vec_id": ids[at[keep]],
                         "score": scores[keep].astype("int64")})


def top_k(vectors, queries, k=TOP):
    """(query_id, rank, vec_id, score) for frames of (id, v)."""
    vectors = stored(vectors, "vectors")
    queries = stored(queries.distinct().withColumn("qhash", F.xxhash64("id", "v")), "queries")
    row_blocks, query_blocks = -(-vectors.count() // ROWS_IN_BLOCK) or 1, -(-queries.count() // QUERIES_IN_BLOCK) or 1

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # A row's block also depends on its vector's hash, so rows repeated under one id need not share a block.
    left = vectors.withColumn("rb", F.pmod(F.xxhash64("id", "v"), F.lit(row_blocks)).cast("int")).withColumn("qb", every(query_blocks))
    right = queries.withColumn("qb", F.pmod("qhash", F.lit(query_blocks)).cast("int")).withColumn("rb", every(row_blocks))

    def search(rows, asked):
        if not len(rows) or not len(asked):
            return pd.DataFrame({"query_id": [], "qhash": [], "vec_id": [], "score": []}, dtype="int64")
        return block_search(rows, asked, k)

    found = (left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb"))
             .applyInPandas(search, "query_id long, qhash long, vec_id long, score long"))
    by = W.partitionBy("query_id", "qhash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(embeddings):
    held = quantised(embeddings, "vec_id", "embedding")
    return top_k(held, held.where(F.pmod("id", F.lit(EVERY)) == 0))
