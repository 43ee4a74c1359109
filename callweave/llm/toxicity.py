"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents labelled toxic; the unlabelled sample is drawn from all documents of the training fold, whatever
their label. The share of toxic documents (the class prior) is estimated from the labels of the training fold. Features say
that a document has a word, or words of one beginning, at least once, twice or three times; those that tell positives from
the rest are chosen on the sample and linear classifiers are trained on it in numpy with the non-negative risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)).

The sample is bounded (POSITIVES, UNLABELLED), drawn evenly by hash; every whole text is scored.

Cases: null and empty texts have no features and get the score of the bias; labels for unknown ids, repeated labels (the
highest counts) and null labels do no harm; without any positive example every score is 0; repeated rows are scored each; an
empty table gives no rows.
"""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from .common import stored, tasks

# Bounds of the training sample, in documents, and of the features kept.
POSITIVES, UNLABELLED, FEATURES = 4000, 8000, 1024
# Beginnings of a word that count like words, and how often a document must have one for each of its features.
BEGINNINGS, LEVELS = (4, 5, 6, 7), (1, 2, 3)
CLASSIFIERS, EPOCHS, BATCH, RATE, DECAY = 3, 60, 512, 0.05, 1e-3
LETTERS = re.compile(r"[^\W\d_]+")
FOLDS = 5


def stems(word):
    """A word and its beginnings."""
    return (word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n))


def words(text):
    """How often a text has each run of letters."""
    return Counter(LETTERS.findall((text or "").lower()))


def features(text):
    """The features of a text: (stem, level) as one string."""
    seen = Counter()
    for word, n in words(text).items():
        for stem in stems(word):
            seen[stem] += n
    return {f"{stem}#{level}" for stem, n in seen.items() for level in LEVELS if n >= level}


def held_out(doc_id):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def below(hash_column, share):
    """Whether a 64-bit hash lies in the lowest share of its range, at the hash's full width."""
    return hash_column < F.lit(int(share * 2**64) - 2**63) if share < 1 else F.lit(True)


def smallest(rows, k, distinct):
    """(text) of the k rows of smallest draw among rows of (id, text), repeated rows once. `distinct` is about how many different ones there are: hashes
    far above those of the k smallest are passed over first, then the k-th smallest is found among bare hashes; texts move last, a row at a time."""
    draw = F.xxhash64(F.lit("draw"), "id", "text")
    near = rows.select("text", draw.alias("draw"), F.xxhash64(F.lit("second"), "id", "text").alias("key")).where(below(F.col("draw"), (2 * k + 100) / max(1, distinct)))
    last = near.select("draw").distinct().orderBy("draw").limit(k).agg(F.max("draw")).first()[0]
    held = near.where(F.col("draw") <= F.lit(last if last is not None else 0))
    return held.groupBy("draw", "key").agg(F.first("text").alias("text")).select("text")


def sample(docs, labels, doc_id, text):
    """(text, positive) rows of the training sample, at most POSITIVES and UNLABELLED of them, and the prior."""
    known = labels.where(~held_out("doc_id") & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count(F.lit(1)), F.sum((F.col("toxic") == 1).cast("int"))).first()
    if not toxic:
        return None, 0.0
    # Ids are drawn first, some more than needed, so this side of the join is small and bounded; what they hold is bounded by `smallest`.
    chosen = known.where((F.col("toxic") == 1) & below(F.xxhash64(F.lit("id"), "doc_id"), (2 * POSITIVES + 100) / toxic)).select("doc_id")
    fold = docs.where(~held_out(doc_id)).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    size = fold.agg(F.approx_count_distinct(F.xxhash64("id", "text"))).first()[0]
    confirmed = stored(fold.join(F.broadcast(chosen), fold["id"] == chosen["doc_id"]).select("id", "text").groupBy("id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit("second"), "text").alias("h2"))
                       .agg(F.first("text").alias("text")), "toxicity-confirmed")
    some = smallest(fold, UNLABELLED, size).withColumn("positive", F.lit(False))
    positive = smallest(confirmed, POSITIVES, confirmed.count()).withColumn("positive", F.lit(True))
    both = some.unionByName(positive).withColumnRenamed("text", text)
    return stored(both.repartition(tasks(docs.sparkSession)), "toxicity-sample"), toxic / n


def choose(rows, text, limit=FEATURES):
    """The features whose share among positives exceeds that among the unlabelled most clearly."""
    def count(batches):
        for batch in batches:
            seen = {True: Counter(), False: Counter()}
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[y].update(features(t))
            names = list(seen[True].keys() | seen[False].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([seen[y][x] for x in names], pa.int64()) for y in (True, False)]],
                                             names=["feature", "p", "u"])

    sizes = {r["positive"]: r["count"] for r in rows.groupBy("positive").count().collect()}
    n_p, n_u = max(1, sizes.get(True, 0)), max(1, sizes.get(False, 0))
    counted = rows.select(text, "positive").mapInArrow(count, "feature string, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    p, u = F.col("p") / n_p, F.col("u") / n_u
    clear = (p - u) / F.sqrt(p / n_p + (F.col("u") + 1) / n_u / n_u)
    best = counted.where("p >= 3").withColumn("clear", clear).where("clear > 2").orderBy(F.desc("clear"), "feature").limit(limit)
    return [r["feature"] for r in best.select("feature").collect()]


def design(rows, text, names):
    """The sample as a 0/1 matrix over the chosen features, and which rows are positive."""
    place = {f: i for i, f in enumerate(names)}

    def indices(batches):
        for batch in batches:
            on = [[place[f] for f in features(t) if f in place] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(on, pa.list_(pa.int32()))], names=["positive", "on"])

    held = rows.select(text, "positive").mapInArrow(indices, "positive boolean, on array<int>").collect()
    x = np.zeros((len(held), len(names)), np.float32)
    for i, r in enumerate(held):
        x[i, r["on"]] = 1
    return x, np.array([r["positive"] for r in held], bool)


def pu_risk(p, u, w, b, prior):
    """(risk, its negative part, gradients of the positive and of the negative part) of a linear classifier over rows of positives and of
    unlabelled: the loss of calling a positive negative is 1 - s, of calling a negative positive s; the negatives' share of the unlabelled is
    what is left when the positives' is taken off."""
    s_p, s_u = sigmoid(p @ w + b), sigmoid(u @ w + b)
    d_p, d_u = s_p * (1 - s_p) / len(p), s_u * (1 - s_u) / len(u)
    negative = s_u.mean() - prior * s_p.mean()
    grad_negative = np.append(u.T @ d_u - prior * (p.T @ d_p), d_u.sum() - prior * d_p.sum())
    grad_positive = -prior * np.append(p.T @ d_p, d_p.sum())
    return prior * (1 - s_p.mean()) + max(0.0, negative), negative, grad_positive, grad_negative


def nonnegative_pu(x_p, x_u, prior, seed):
    """Weights and bias of a linear classifier under the non-negative PU risk with the sigmoid loss (Adam steps; where the
    estimated negative risk falls below zero, the step raises it again)."""
    rng = np.random.default_rng(seed)
    w, b = np.zeros(x_p.shape[1]), float(np.log(prior / (1 - prior)))
    m, v, t = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    share = max(1, len(x_u) // BATCH)
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(x_u)), share):
            p, u = x_p[rng.integers(0, len(x_p), min(BATCH, len(x_p)))], x_u[part]
            _, negative, grad_positive, grad_negative = pu_risk(p, u, w, b, prior)
            g = grad_positive + grad_negative if negative >= 0 else -grad_negative
            g += DECAY * np.append(w, 0) / len(w)
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
    return w, b


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(docs, labels, doc_id="doc_id", text="text"):
    """(feature weights, bias): the mean of several classifiers; None without a positive example."""
    rows, prior = sample(docs, labels, doc_id, text)
    if rows is None:
        return None
    names = choose(rows, text)
    x, positive = design(rows, text, names)
    if not positive.any() or positive.all():
        return None
    found = [nonnegative_pu(x[positive], x[~positive], min(max(prior, 0.001), 0.9), seed) for seed in range(CLASSIFIERS)]
    weights = np.mean([w for w, _ in found], axis=0)
    return dict(zip(names, weights.tolist())), float(np.mean([b for _, b in found]))


def scorer(model):
    """A column function: the score of a text."""
    weights, bias = model if model else ({}, -np.inf)

    wanted = {f.rpartition("#")[0] for f in weights}

    def run(texts: pd.Series) -> pd.Series:
        known, scores = {}, []
        for text in texts:
            seen = Counter()
            for word, n in words(text).items():
                hits = known.get(word)
                if hits is None:
                    hits = known[word] = tuple(stem for stem in stems(word) if stem in wanted)
                for stem in hits:
                    seen[stem] += n
            if len(known) > 300_000:
                known.clear()
            z = bias + sum(weights.get(f"{stem}#{level}", 0.0) for stem, n in sorted(seen.items()) for level in LEVELS if n >= level)
            scores.append(float(sigmoid(z)) if z > -np.inf else 0.0)
        return pd.Series(scores, dtype="float64", index=texts.index)
    return pandas_udf(run, DoubleType())


def scored(docs, labels, doc_id="doc_id", text="text"):
    """docs with held_out, score and predicted; labels has doc_id and toxic."""
    score = scorer(fit(docs, labels, doc_id, text))
    return docs.withColumns({"held_out": held_out(doc_id), "score": score(F.col(text))}).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs, labels, doc_id="doc_id", text="text"):
    """The rows of docs that score below 0.5."""
    return docs.where(scorer(fit(docs, labels, doc_id, text))(F.col(text)) < 0.5)


def report(docs, labels):
    return scored(docs.select("doc_id", "text"), labels).drop("text")
