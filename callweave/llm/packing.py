"""Best-fit packing of token pieces by patterns fitted with non-negative least squares.

Spark cuts every text into pieces of at most `capacity` tokens and counts the lengths. The plan is made on that histogram
alone (at most `capacity` numbers, whatever the corpus): patterns of two or three lengths that fill a sequence exactly are
enumerated, their repeat counts are fitted to the histogram by non-negative least squares and rounded, and what remains is
packed best fit, longest first. The plan is a list of runs (pattern, repeats); pieces are numbered within their length and
look their place up in it.

Cases: null and empty texts are the closing id alone; repeated rows and null ids are packed like any other row; a text of
any length is cut; an empty table gives no rows. Only the id and text columns are read.
"""

import os
import zlib
from array import array
from collections import Counter
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import small, stored

CAPACITY, CLOSING = 2048, 0
# Words whose ids a Python worker remembers before it starts anew.
REMEMBERED = 500_000
# Pieces numbered together within one length.
RANK_ROWS = 50_000
# Steps of the least-squares iteration, and middle lengths tried for patterns of three.
ROUNDS, MIDDLES = 400, 48
# Shares of the fitted repeats that are tried; the last is best fit alone, so that no plan is worse than it.
SHARES = (1.0, 0.9, 0.6, 0.3, 0.0)


def byte_letters():
    """The letter that stands for each byte in the vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordIds:
    """Token ids of texts as little-endian unsigned 32-bit bytes. The tokenizer never joins text over ASCII white space and
    lower-cases it, and its pieces never mix letters with other signs; so ids are those of the words between, and those of a
    word with signs after it are the word's and the signs'. Words are looked up once. A new word of lower-case letters in normal
    form is one piece as it stands and goes straight to the model; any other goes through the whole tokenizer."""

    SIGNS = b".,;:!?%#&*$"

    def __init__(self, path):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer, self.known = Tokenizer.from_file(path), Remembered(self.learn)
        self.model, self.letters = self.tokenizer.model, byte_letters()

    def learn(self, word):
        """The ids of a word seen for the first time."""
        if b"<|" in word:  # may hold a special token, which is not lower-cased
            return self.whole(word)
        low = word.lower()
        base = low.rstrip(self.SIGNS)
        if base != low and base[-1:].isalnum():
            return self.known[base] + self.known[low[len(base):]]
        text = low.decode()
        if not (text.isalpha() and text == text.lower() and is_normalized("NFC", text)):
            return self.whole(low)
        found = self.model.tokenize(text if text.isascii() else low.decode("latin-1").translate(self.letters))
        return array("I", [t.id for t in found]).tobytes()

    def whole(self, word):
        return array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def encode(self, texts):
        for text in texts:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            yield b"".join(map(self.known.__getitem__, (text or "").encode().split()))


class Remembered(dict):
    """What a function gave for each key asked for."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, key):
        found = self[key] = self.find(key)
        return found


_ENCODERS = {}


def pieces(docs, doc_id, text, path, capacity=CAPACITY):
    """(id, piece, start, length, ids_crc32) of every text's ids and the closing id, cut after each `capacity` tokens."""
    closing = np.array([CLOSING], "<u4").tobytes()
    kind = docs.schema[doc_id].dataType
    fields = pa.schema([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches):
        if path not in _ENCODERS:  # kept from task to task
            _ENCODERS[path] = WordIds(path)
        coder = _ENCODERS[path]
        for batch in batches:
            rows, made = [], []
            for i, ids in enumerate(coder.encode(batch.column(1).to_pylist())):
                ids = memoryview(ids + closing)
                n = len(ids) // 4
                for p, s in enumerate(range(0, n, capacity)):
                    rows.append(i)
                    made.append((p, s, min(capacity, n - s), zlib.crc32(ids[4 * s:4 * (s + capacity)])))
            columns = list(zip(*made)) if made else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), *[pa.array(c, t) for c, t in zip(columns, fields.types)]],
                                             names=[doc_id, *fields.names])

    schema = f"`{doc_id}` {kind.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return docs.select(doc_id, text).mapInArrow(cut, schema)


def exact_patterns(lengths, capacity, middles=MIDDLES):
    """Rows of three lengths (0 for none) that sum to capacity: all pairs, and triples over evenly spaced middle lengths."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    a = np.array(lengths)
    pairs = a[(a * 2 >= capacity) & (a < capacity)]
    pairs = pairs[have[capacity - pairs]]
    found = [np.stack([pairs, capacity - pairs, np.zeros_like(pairs)], 1)]
    inner = a[a < capacity]
    for m in inner[np.unique(np.linspace(0, len(inner) - 1, min(middles, len(inner))).astype(int))] if len(inner) else []:
        rest = capacity - m - a
        ok = (rest > 0) & (a >= rest)
        x, r = a[ok], rest[ok]
        ok = have[r]
        found.append(np.sort(np.stack([x[ok], np.full(ok.sum(), m), r[ok]], 1), 1)[:, ::-1])
    return np.unique(np.concatenate(found), axis=0)


def nonnegative_fit(patterns, counts, rounds=ROUNDS):
    """x >= 0 that brings the lengths used by x repeats of each pattern close to counts in least squares (multiplicative
    updates, which keep x non-negative)."""
    used = patterns > 0
    flat, of = patterns[used], np.nonzero(used)[0]
    goal = np.bincount(of, counts[flat], len(patterns))
    x = np.full(len(patterns), counts.sum() / max(1, len(flat)))
    for _ in range(rounds):
        fit = np.bincount(flat, x[of], len(counts))
        x *= goal / np.maximum(np.bincount(of, fit[flat], len(patterns)), 1e-12)
    return x


def plan(counts, capacity=CAPACITY):
    """Runs (pattern, repeats) that place counts[n] pieces of every length n; a pattern is a tuple of (length, times). The
    fitted repeats are taken whole and in part, and the plan of fewest sequences is kept."""
    left, runs = counts.astype(np.int64).copy(), []
    if left[capacity]:
        runs.append((((capacity, 1),), int(left[capacity])))
        left[capacity] = 0
    lengths = np.nonzero(left)[0]
    patterns = exact_patterns(lengths, capacity) if len(lengths) else np.zeros((0, 3), int)
    x = nonnegative_fit(patterns, left.astype(float)) if len(patterns) else np.zeros(0)
    plans = [rounded(patterns, x * share, left, capacity) for share in SHARES]
    return runs + min(plans, key=lambda found: sum(n for _, n in found))


def rounded(patterns, x, counts, capacity):
    """Whole repeats near x, and best fit for the rest. Running sums round each pattern so that sums over neighbours stay near
    the fit; stock on hand limits them."""
    left, runs = counts.copy(), []
    order = np.lexsort((-patterns[:, 1], -patterns[:, 0]))
    wanted = np.diff(np.floor(np.concatenate([[0.0], np.cumsum(x[order])]) + 1e-9)).astype(np.int64)
    for p, n in zip(patterns[order][wanted > 0].tolist(), wanted[wanted > 0].tolist()):
        need = Counter(v for v in p if v)
        n = min(n, *(int(left[v]) // t for v, t in need.items()))
        if n > 0:
            runs.append((tuple(sorted(need.items(), reverse=True)), n))
            for v, t in need.items():
                left[v] -= n * t
    return runs + best_fit(left, capacity)


def best_fit(counts, capacity):
    """Best fit, longest first, on counts: bins of equal content are one entry, so work follows the number of lengths."""
    bins = {}  # free space -> [(content, how many)]
    for n in np.nonzero(counts)[0][::-1].tolist():
        todo = int(counts[n])
        while todo:
            room = min((s for s in bins if s >= n), default=None)
            content, have = bins[room].pop() if room is not None else ((), todo)
            space = room if room is not None else capacity
            each = space // n
            times = min(each, todo)
            whole = min(have, todo // times)
            bins.setdefault(space - n * times, []).append((content + ((n, times),), whole))
            if room is not None and have > whole:
                bins[room].append((content, have - whole))
            if room is not None and not bins[room]:
                del bins[room]
            todo -= whole * times
    return [run for entries in bins.values() for run in entries]


def places(runs):
    """(length, first rank, after the last rank, times, first sequence, offset) rows of a plan."""
    rank, sequence, rows = {}, 0, []
    for content, repeats in runs:
        at = 0
        for n, times in content:
            first = rank.get(n, 0)
            rows.append((n, first, first + repeats * times, times, sequence, at))
            rank[n] = first + repeats * times
            at += n * times
        sequence += repeats
    return rows


def pack(docs, path, doc_id="doc_id", text="text", capacity=CAPACITY):
    """Pieces of docs with sequence_id and offset."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, doc_id, text, path, capacity), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    total = 0
    for n, c in cut.groupBy("length").count().collect():  # at most `capacity` rows
        counts[n], total = c, total + c
    rows = places(plan(counts, capacity))
    known = "length long, first long, after long, times long, sequence long, at long"
    lookup = small(spark.createDataFrame(rows, known), len(rows))
    parts = max(32, -(-total // RANK_ROWS))
    spread = cut.withColumn("__part", F.pmod(F.xxhash64(doc_id, "piece"), F.lit(parts)))
    base = (spread.groupBy("length", "__part").count()
            .withColumn("__base", F.sum("count").over(W.partitionBy("length").orderBy("__part")) - F.col("count")).drop("count"))
    number = F.row_number().over(W.partitionBy("length", "__part").orderBy(doc_id, "piece", "ids_crc32"))
    ranked = (spread.withColumn("__n", number).join(base, ["length", "__part"])
              .withColumn("rank", F.col("__base") + F.col("__n") - 1))
    inside = F.col("rank") - F.col("first")
    return (ranked.join(lookup, "length").where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("after")))
            .select(doc_id, "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.floor(inside / F.col("times"))).alias("sequence_id"),
                    (F.col("at") + F.pmod(inside, F.col("times")) * F.col("length")).alias("offset")))


def report(docs):
    import public_tokenizers
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
