"""Periodic runs of words: online dynamic programming over the diagonals of equal words.

A lag q is a diagonal; on it, word i matches if it equals word i - q. The words are read once, in order. Every active diagonal
whose word matches again grows by one; one that does not match ends, and if its stretch is long enough it is emitted at once.

Only earlier occurrences that can begin a run open a diagonal. A run of period q below 8 has 6 matches in a row on its diagonal, any
other run has q of them; so for q in [b, 2b), b a power of two, a diagonal opens where the b words that end here stood q words
earlier, and the words before them differ (it could not have begun sooner). Names for blocks of 2, 4, 8 ... words are built by
doubling, as long as any name repeats. A diagonal opened inside the stretch of an active one whose lag divides its own would begin
and end with that one, and is left out. So a text of one repeated word costs a constant per word, as does one without repeats.

Cases: null, empty and blank texts have no words and no runs; a text of any length is taken whole; nested and overlapping runs are all
reported; repeated rows are each reported; a null id plants nothing; an empty table gives no rows. Extra columns pass through `with_runs`,
which replaces a column of the name it writes.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

# A run has so many words at least, and twice its period.
LEAST = 12
SHORT_BLOCK, SHORT_LAGS = 6, 8
RUN = "struct<start: bigint, length: bigint, period: bigint>"
RESULT = f"struct<n_words: bigint, runs: array<{RUN}>, collapsed: binary>"


def pairs_named(left, right):
    """One number per distinct pair."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def block_names(words):
    """(length, names) of the blocks of 6, 8, 16, 32 ... words by their first word, while a block repeats and can begin a run."""
    size, names = 1, words
    while len(names) and names.max() + 1 < len(names):
        if size * 2 > len(words):
            return
        if size == 4 and len(words) >= SHORT_BLOCK:
            pairs = names_of_two[2:]
            yield SHORT_BLOCK, pairs_named(names[:len(pairs) - 2], pairs[2:])
        names = pairs_named(names[:-size], names[size:])
        size *= 2
        if size == 2:
            names_of_two = names
        if size >= SHORT_LAGS:
            yield size, names


def openings(words):
    """(last word, lag, length) of every place where a diagonal opens."""
    found = []
    before = np.r_[-1, words]
    for size, names in block_names(words):
        low, high = (1, SHORT_LAGS) if size == SHORT_BLOCK else (size, 2 * size)
        # Names that follow at least two different words.
        prior = before[:len(names)]
        first = np.full(int(names.max()) + 1, -2)
        first[names[::-1]] = prior[::-1]
        mixed = np.zeros(len(first), bool)
        mixed[names[prior != first[names]]] = True
        seen = {}
        for at in np.flatnonzero(mixed[names]).tolist():
            held = seen.setdefault(int(names[at]), [])  # (place, word before, index of the latest with another word before)
            c = int(prior[at])
            k = len(held) - 1
            while k >= 0 and at - held[k][0] < high:
                place, word, skip = held[k]
                if word == c:
                    k = skip
                    continue
                if at - place >= low:
                    found.append((at + size - 1, at - place, size))
                k -= 1
            if held:
                skip = len(held) - 1 if held[-1][1] != c else held[-1][2]
            else:
                skip = -1
            held.append((at, c, skip))
    found.sort()
    return found


def find_runs(words, least=LEAST):
    """(start, length, period) of every run of a sequence of word numbers, by start, then period."""
    words = np.unique(np.asarray(words, np.int64), return_inverse=True)[1]
    found = openings(words)
    if not found:
        return []
    w, runs, active, n, k = words.tolist(), [], {}, len(words), 0  # active: lag -> matches so far

    def end(lags, i):
        best = {}
        for lag in lags:
            length = active.pop(lag) + lag
            if length >= max(least, 2 * lag):
                start = i - length
                best[start] = min(lag, best.get(start, lag))
        runs.extend((start, i - start, lag) for start, lag in best.items())

    i = found[0][0]
    while i < n:
        over = []
        for lag in active:
            if w[i] == w[i - lag]:
                active[lag] += 1
            else:
                over.append(lag)
        if over:
            end(over, i)
        while k < len(found) and found[k][0] == i:
            _, lag, length = found[k]
            k += 1
            # Nothing new inside the stretch of a divisor.
            if not any(lag % d == 0 and m + d >= length + lag for d, m in active.items()):
                active[lag] = length
        if active:
            i += 1
        elif k < len(found):
            i = found[k][0]
        else:
            break
    end(list(active), n)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept(words, runs):
    """The words without those that any run holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [word for word, held in zip(words, keep.tolist()) if held]


def analysed(text, least=LEAST, rewrite=None, doc_id=None):
    """Runs of one text (bytes or None), as a row of RESULT."""
    words = text.split() if text else []
    if rewrite:
        words = rewrite(doc_id, words)
    numbers = {}
    runs = find_runs([numbers.setdefault(word, len(numbers)) for word in words], least)
    return {"n_words": len(words), "runs": [dict(zip(("start", "length", "period"), r)) for r in runs],
            "collapsed": b" ".join(kept(words, runs) if runs else words)}


def with_runs(docs, text="text", column="runs", least=LEAST, rewrite=None, doc_id=None):
    """docs with a struct of n_words, runs and the collapsed text (UTF-8 bytes). rewrite(id as text, words) may change the words first."""
    kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))), ("collapsed", pa.binary())])

    def run(ids: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([analysed(t.as_py(), least, rewrite, i.as_py()) for i, t in zip(ids, texts)], kind)

    key = F.col(doc_id).cast("string") if doc_id else F.lit(None).cast("string")
    return docs.withColumn(column, F.arrow_udf(run, RESULT)(key, F.col(text).cast("binary")))


def planted(doc_id, words):
    """The words, in every tenth document (by the crc32 of its id) repeating a period from some word to the end."""
    n = len(words)
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def report(docs):
    """Digests of the runs of all documents, after the planting of the contract."""
    held = with_runs(docs.select("doc_id", "text"), column="r", rewrite=planted, doc_id="doc_id").select("doc_id", "r.*")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    # The greatest length, then the smallest start and period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    held = held.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.col3")
    return held.select("doc_id", "n_runs", (-F.col("best.col2")).alias("start"), length.alias("length"), period.alias("period"),
                       F.expr("1000 * best.length div -best.col3").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
