"""Sequence matching between transcripts, as Arrow jobs.

The unit of work is one call: its words meet in one row, and Spark spreads calls over tasks. Only the matcher itself
runs in Python; cutting segments into words, joining systems, shares and votes stay in the JVM.
"""

import math
import sys
from difflib import Match

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..session import settle, spread

# Executors need not have this package installed: its task code travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values ----
MIN_TOTAL_MATCH, MIN_RUN, TAIL_WORDS, HEAD_WORDS = 6, 3, 150, 200
# ---- end of fixed values ----


def _longest(a, b, alo, ahi, blo, bhi):
    """(i, j, n) of the longest stretch two texts share within bounds, the earliest in a and then in b, as difflib picks it."""
    best, at, i = 0, alo, alo
    while i + best < ahi:
        j = b.find(a[i:i + best + 1], blo, bhi)
        while j >= 0:
            n = best + 1
            while i + n < ahi and j + n < bhi and a[i + n] == b[j + n]:
                n += 1
            best, at = n, i
            # An equal stretch that goes further may stand later in b.
            j = b.find(a[i:i + n + 1], j + 1, bhi) if i + n < ahi else -1
        i += 1
    return at, b.find(a[at:at + best], blo, bhi) if best else blo, best


def _as_texts(a, b):
    """Two word lists as texts of one character a word, equal across the two where the words are."""
    codes = {word: chr(n + 2) for n, word in enumerate(set(a).intersection(b))}
    return ["".join(codes.get(word, alone) for word in words) for words, alone in ((a, chr(0)), (b, chr(1)))]


def _blocks(a, b):
    """SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks(). Its loop over all places of every element is quadratic; here the longest
    stretch comes from substring searches, which skip ahead by the length found so far."""
    x, y = (a, b) if isinstance(a, str) else _as_texts(a, b)
    found, queue = [], [(0, len(x), 0, len(y))]
    while queue:
        alo, ahi, blo, bhi = queue.pop()
        i, j, n = _longest(x, y, alo, ahi, blo, bhi)
        if n:
            found.append((i, j, n))
            if alo < i and blo < j:
                queue.append((alo, i, blo, j))
            if i + n < ahi and j + n < bhi:
                queue.append((i + n, ahi, j + n, bhi))
    joined = []
    for i, j, n in sorted(found):
        if joined and joined[-1][0] + joined[-1][2] == i and joined[-1][1] + joined[-1][2] == j:
            joined[-1] = Match(*joined[-1][:2], joined[-1][2] + n)
        else:
            joined.append(Match(i, j, n))
    return [*joined, Match(len(x), len(y), 0)]


def _ratio(a, b):
    """SequenceMatcher(None, a, b, autojunk=False).ratio()."""
    return 2.0 * sum(m.size for m in _blocks(a, b)) / (len(a) + len(b)) if len(a) + len(b) else 1.0


@F.pandas_udf(T.DoubleType())
def text_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Character similarity of two compact texts; a null text needs none."""
    return pd.Series([None if x is None else _ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in ("wg", "ws", "gs")]))
def _three_ratios(a1: pd.Series, b1: pd.Series, a2: pd.Series, b2: pd.Series, a3: pd.Series, b3: pd.Series) -> pd.DataFrame:
    """Ratios of three pairs; a null text means that pair needs none."""
    ratio = lambda a, b: [None if x is None else _ratio(x, y) for x, y in zip(a, b)]
    return pd.DataFrame({"wg": ratio(a1, b1), "ws": ratio(a2, b2), "gs": ratio(a3, b3)}, dtype="float64")


def shared_characters(a, b):
    """How many characters two texts share when their order does not count: no matching of them can use more."""
    count = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    each = F.transform(F.filter(F.array_distinct(F.split(a, "")), lambda c: c != ""), lambda c: F.least(count(a, c), count(b, c)))
    return F.aggregate(each, F.lit(0), lambda total, n: total + n)


def vote_ratios(rows, first, second, third, short, threshold):
    """Adds wg, ws and gs: whether each pair of compact texts agrees. Short or equal pairs are decided natively, and so are pairs that cannot reach
    the threshold: by their lengths (2*min/(a+b) bounds the ratio), or by the characters they share at all. One Arrow call serves the rest, dealt
    evenly whatever the texts are."""
    pairs = (("wg", first, second), ("ws", first, third), ("gs", second, third))
    natives, inputs = {}, []
    for name, a, b in pairs:
        x, y = F.col(a), F.col(b)
        natives["__n" + name] = (F.when(x == y, True).when(F.greatest(F.length(x), F.length(y)) < short, False)
                                 .when(2 * F.least(F.length(x), F.length(y)) < threshold * (F.length(x) + F.length(y)), False)
                                 .when(2 * shared_characters(x, y) < threshold * (F.length(x) + F.length(y)), False))
        unknown = F.col("__n" + name).isNull()
        inputs += [F.when(unknown, x), F.when(unknown, y)]
    rows = spread(rows.withColumns(natives)).withColumn("__r", _three_ratios(*inputs))
    rows = rows.withColumns({name: F.coalesce("__n" + name, F.col("__r." + name) >= threshold) for name, _, _ in pairs})
    return rows.drop("__r", *natives)


def call_words(segments, by="segment_id"):
    """Per call its comparable words in order, each with the segment it comes from."""
    rows = segments.select("call_id", F.struct(F.col(by).alias("at"), tx.comparable_words(F.col("text")).alias("words")).alias("x"))
    ordered = rows.groupBy("call_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return ordered.select("call_id", F.flatten(F.transform("xs", lambda x: x["words"])).alias("words"),
                          F.flatten(F.transform("xs", lambda x: F.transform(x["words"], lambda _: x["at"]))).alias("owners"))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("i", "j", "n")])))
def _match_blocks(words: pd.Series, theirs: pd.Series) -> pd.Series:
    """The stretches two word lists share, in order, and an empty one at their ends."""
    return pd.Series([[dict(zip("ijn", m)) for m in _blocks(list(a), [] if b is None else list(b))] for a, b in zip(words, theirs)])


def word_owners(base, other):
    """For each call, whether the other system has each base word, and the base position each other word belongs to.

    `base` and `other` come from call_words. Python finds the shared stretches; everything else is columns: words of the other
    system inside a stretch belong to the base word they equal, those between two stretches are spread evenly over the base
    words there, or go with the next base word where there is none. Output rows: call_id, side ('base' / 'other'), at (word
    position), word, owner (segment the word belongs to), turn, matched. Settled, because every share and vote starts from it."""
    pairs = base.select("call_id", "words", "owners").join(
        other.select("call_id", F.col("words").alias("theirs"), F.col("owners").alias("turns")), "call_id", "left")
    matched = spread(pairs, "call_id").withColumn("blocks", _match_blocks("words", "theirs"))
    # Each shared stretch with the gap before it: base words i0..i-1 against other words j0..j-1.
    before = lambda k, side: F.when(k > 0, F.get("blocks", k - 1)[side] + F.get("blocks", k - 1)["n"]).otherwise(0)
    spans = F.transform("blocks", lambda m, k: F.struct(before(k, "i").alias("i0"), before(k, "j").alias("j0"), m["i"].alias("i"), m["j"].alias("j"), m["n"].alias("n")))
    matched = matched.withColumn("spans", spans)
    run = lambda start, count: F.when(count > 0, F.sequence(start, start + count - 1)).otherwise(F.array().cast("array<int>"))
    last = F.size("words") - 1

    def mine(i, hit):
        return F.struct(F.lit("base").alias("side"), i.alias("at"), F.get("words", i).alias("word"), F.get("owners", i).alias("owner"),
                        F.lit(None).cast("bigint").alias("turn"), F.lit(hit).alias("matched"))

    def heard(j, i, hit):
        return F.struct(F.lit("other").alias("side"), j.alias("at"), F.get("theirs", j).alias("word"), F.get("owners", i.cast("int")).alias("owner"),
                        F.get("turns", j).cast("bigint").alias("turn"), F.lit(hit).alias("matched"))

    def rows(s):
        gap = s["i"] - s["i0"]
        share = lambda j: F.when(gap > 0, s["i0"] + F.floor((j - s["j0"]) * gap / (s["j"] - s["j0"]))).otherwise(F.least(s["i0"], last))
        return F.concat(F.transform(run(s["i0"], gap), lambda i: mine(i, False)), F.transform(run(s["i"], s["n"]), lambda i: mine(i, True)),
                        F.transform(run(s["j0"], s["j"] - s["j0"]), lambda j: heard(j, share(j), False)),
                        F.transform(run(s["j"], s["n"]), lambda j: heard(j, s["i"] + j - s["j"], True)))

    words = matched.select("call_id", F.inline(F.flatten(F.transform("spans", rows))))
    return settle(words.withColumns({"at": F.col("at").cast("bigint"), "owner": F.col("owner").cast("bigint")}))


def segment_agreement(segments, owners):
    """Per base segment the other system's words for it, the share both agree on and the character similarity."""
    per = owners.filter(F.col("owner").isNotNull()).groupBy("call_id", F.col("owner").alias("segment_id")).agg(
        F.count_if(F.col("side") == "base").alias("base_words"), F.count_if((F.col("side") == "base") & F.col("matched")).alias("matched_words"),
        F.count_if(F.col("side") == "other").alias("other_count"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == "other", F.struct("at", "word")))), lambda x: x["word"]), " ").alias("other_text"))
    rows = segments.select("call_id", "segment_id", "text").join(per, ["call_id", "segment_id"], "left").na.fill(
        0, ["base_words", "matched_words", "other_count"]).na.fill("", ["other_text"])
    longest = F.greatest("base_words", "other_count")
    rows = rows.withColumn("agreement", F.when(longest == 0, 1.0).otherwise(F.col("matched_words") / F.nullif(longest, F.lit(0))))
    rows = rows.withColumns({"__a": tx.compact(F.col("text")), "__b": tx.compact(F.col("other_text"))})
    native = F.when(F.col("__a") == F.col("__b"), 1.0).when((F.col("__a") == "") | (F.col("__b") == ""), 0.0)
    rows = spread(rows.withColumn("__n", native), "call_id", "segment_id")
    asked = F.col("__n").isNull()
    ratio = text_ratio(F.when(asked, F.col("__a")), F.when(asked, F.col("__b")))
    return rows.withColumn("char_agreement", F.coalesce("__n", ratio)).drop("__a", "__b", "__n")


def call_agreement(owners, calls=None):
    """Share of words two systems agree on over a whole call. `calls` (call_id) adds those without a word in either: 1."""
    per = owners.groupBy("call_id").agg(F.count_if(F.col("side") == "base").alias("b"), F.count_if(F.col("side") == "other").alias("o"),
                                        F.count_if((F.col("side") == "base") & F.col("matched")).alias("hits"))
    shares = per.select("call_id", (F.col("hits") / F.nullif(F.greatest("b", "o"), F.lit(0))).alias("agreement"))
    if calls is None:
        return shares
    return calls.select("call_id").distinct().join(shares, "call_id", "left").na.fill(1.0, ["agreement"])


def segment_speakers(owners, turns):
    """Majority speaker of the other system's words aligned to each base segment. `turns` has call_id, turn, speaker."""
    from .consensus import majority_label
    words = owners.filter((F.col("side") == "other") & F.col("owner").isNotNull()).select("call_id", "turn", F.col("owner").alias("segment_id"), "at")
    return majority_label(words.join(turns.select("call_id", "turn", "speaker"), ["call_id", "turn"]), ["call_id", "segment_id"], "speaker", "at")


def first_heard(turns, passages):
    """Per turn the start of the passage in which its first matched word was heard: `heard_at`, null when not heard.
    Turns are the base here, passages (call_id, segment_id, start, text) the other system."""
    base = call_words(turns.withColumnRenamed("turn", "segment_id"))
    other = call_words(passages)
    pairs = base.join(other.select("call_id", F.col("words").alias("other_words"), F.col("owners").alias("other_owners")), "call_id")

    def match(batches):
        for batch in batches:
            rows = []
            for call, words, owners, theirs, passage in zip(batch["call_id"], batch["words"], batch["owners"], batch["other_words"], batch["other_owners"]):
                seen = {}
                for block in _blocks(list(words), list(theirs)):
                    for k in range(block.size):
                        seen.setdefault(int(owners[block.a + k]), int(passage[block.b + k]))
                rows += [(call, turn, segment) for turn, segment in seen.items()]
            yield pd.DataFrame(rows, columns=["call_id", "turn", "segment_id"])

    heard = settle(spread(pairs, "call_id").mapInPandas(match, "call_id string, turn bigint, segment_id bigint"))
    heard = heard.join(passages.select("call_id", "segment_id", F.col("start").alias("heard_at")), ["call_id", "segment_id"]).drop("segment_id")
    return turns.join(heard, ["call_id", "turn"], "left")


def timed_segments(turns, passages):
    """Turns with monotone start, end and whether the time was heard."""
    from .consensus import turn_times
    return turn_times(first_heard(turns, passages))


def piece_words(pieces):
    """Words of every piece in order: one row per piece with parallel word, comparable form, turn and role lists."""
    rows = pieces.select("call_id", "piece", "turn", "role",
                         F.posexplode(F.filter(F.split("text", r"(?U)\s+"), lambda w: w != "")).alias("at", "word"))
    rows = rows.withColumn("plain", tx.normalise(F.col("word")))
    return rows.groupBy("call_id", "piece").agg(F.array_sort(F.collect_list(F.struct("turn", "at", "word", "plain", "role"))).alias("words"))


def _cuts(said):
    """Per piece how many of its words repeat the text before it: up to the end of the last shared run that is long enough, 0
    without words before it, None without a clear overlap. said: the comparable words of the pieces in order."""
    text, cuts = [], []
    for words in said:
        end = 0
        if text and words:
            runs = [m for m in _blocks(text[-TAIL_WORDS:], words[:HEAD_WORDS]) if m.size]
            ends = [m.b + m.size for m in runs if m.size >= MIN_RUN]
            end = ends[-1] if ends and sum(m.size for m in runs) >= MIN_TOTAL_MATCH else None
        cuts.append(end)
        text += words[end or 0:]
    return cuts


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _piece_cuts(said: pd.Series) -> pd.Series:
    return pd.Series([_cuts([list(words) for words in pieces]) for pieces in said])


def stitch(pieces):
    """Join overlapping pieces of each call: words a piece repeats from the end of the text before it are dropped up to
    the end of the last run of three or more equal words; a join without a clear overlap is kept whole and flagged.

    Where a piece is cut depends on the joined text before it, so one row per call gives its cuts; a call is a bounded recording
    (its pieces last ten minutes each). Cutting and joining the turns are columns. Output: call_id, piece, turn, role, text,
    flag, where flag marks the first row of an unmatched piece."""
    ordered = piece_words(pieces).groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("piece", "words"))).alias("pieces"))
    plain = F.transform("pieces", lambda p: F.transform(p["words"], lambda w: w["plain"]))
    cut = ordered.withColumn("cuts", _piece_cuts(plain))
    left = F.transform("pieces", lambda p, k: F.struct(
        p["piece"].alias("piece"), F.get("cuts", k).isNull().alias("unmatched"),
        F.slice(p["words"], F.coalesce(F.get("cuts", k), F.lit(0)) + 1, F.size(p["words"])).alias("words")))
    rows = cut.select("call_id", F.inline(left)).select("call_id", "piece", "unmatched", F.posexplode("words").alias("place", "w"))
    turns = rows.groupBy("call_id", "piece", "unmatched", F.col("w.turn").alias("turn")).agg(
        F.min_by("w.role", "place").alias("role"), F.min("place").alias("place"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "w.word"))), lambda x: x["word"]), " ").alias("text"))
    flag = F.when(F.col("unmatched") & (F.col("place") == 0), F.concat(F.lit("join_"), F.col("piece").cast("string"), F.lit("_unmatched")))
    return turns.select("call_id", F.col("piece").cast("bigint").alias("piece"), F.col("turn").cast("bigint").alias("turn"), "role", "text", flag.alias("flag"))


def edit_counts(words_a, words_b):
    """(hits, substitutions, deletions, insertions) of a least-edits alignment of two word lists."""
    previous = [(j, 0, 0, 0, j) for j in range(len(words_b) + 1)]  # cost, hits, subs, dels, ins
    for i, a in enumerate(words_a, 1):
        current = [(i, 0, 0, i, 0)]
        for j, b in enumerate(words_b, 1):
            if a == b:
                cost, hits, subs, dels, ins = previous[j - 1]
                current.append((cost, hits + 1, subs, dels, ins))
                continue
            swap, drop, add = previous[j - 1], previous[j], current[j - 1]
            best = min(swap[0], drop[0], add[0])
            if swap[0] == best:
                current.append((best + 1, swap[1], swap[2] + 1, swap[3], swap[4]))
            elif drop[0] == best:
                current.append((best + 1, drop[1], drop[2], drop[3] + 1, drop[4]))
            else:
                current.append((best + 1, add[1], add[2], add[3], add[4] + 1))
        previous = current
    return previous[-1][1:]


# Pairs of so many cells or fewer take the plain table.
PLAIN_CELLS = 2000


class EditColumns:
    """The table of least edits by columns of bits: per word of b, which rows cost one more or one less than the row above, and than the column
    before. A step works on whole columns, 64 rows and more at a time. Every `every`-th column is kept, the others are made anew when needed."""

    def __init__(self, a, b):
        self.b, self.full, self.places = b, (1 << len(a)) - 1, {}
        for i, word in enumerate(a):
            self.places[word] = self.places.get(word, 0) | 1 << i
        self.every = max(1, math.isqrt(len(b)))
        self.kept, column, self.block, self.first = [], (self.full, 0), [], None
        for j in range(len(b)):
            if j % self.every == 0:
                self.kept.append(column)
            column = self.step(column, b[j])[2:]

    def step(self, column, word):
        """(more than the column before, less than it, more than the row above, less than it) for the next column."""
        up, down = column
        same = self.places.get(word, 0)
        either = same | down
        across = (((same & up) + up) ^ up) | same
        more, less = down | ~(across | up) & self.full, up & across
        more_above, less_above = (more << 1 | 1) & self.full, less << 1 & self.full
        return more, less, less_above | ~(either | more_above) & self.full, more_above & either

    def column(self, j):
        """The step that made column j (1 .. len(b)), and the column before it."""
        first = (j - 1) // self.every * self.every
        if first != self.first:
            column, self.first, self.block = self.kept[first // self.every], first, []
            for word in self.b[first:first + self.every]:
                made = self.step(column, word)
                self.block.append((made, column))
                column = made[2:]
        return self.block[j - 1 - first]


def _change(bits, i):
    return (bits[0] >> i & 1) - (bits[1] >> i & 1)


def fast_edit_counts(words_a, words_b):
    """The same as edit_counts, from columns of bits: the way back takes an equal word, else a swap, a drop or an addition, in this order of
    preference, as the plain table does."""
    columns = EditColumns(words_a, words_b)
    i, j, hits, swaps, drops, adds = len(words_a), len(words_b), 0, 0, 0, 0
    while i and j:
        if words_a[i - 1] == words_b[j - 1]:
            hits, i, j = hits + 1, i - 1, j - 1
            continue
        made, before = columns.column(j)
        add = -_change(made[:2], i - 1)
        drop, swap = -_change(made[2:], i - 1), add - _change(before, i - 1)
        if swap <= min(drop, add):
            swaps, i, j = swaps + 1, i - 1, j - 1
        elif drop <= add:
            drops, i = drops + 1, i - 1
        else:
            adds, j = adds + 1, j - 1
    return hits, swaps, drops + i, adds + j


@F.pandas_udf(T.StructType([T.StructField(n, T.LongType()) for n in ("hits", "substitutions", "deletions", "insertions")]))
def _edits(reference: pd.Series, hypothesis: pd.Series) -> pd.DataFrame:
    rows = [(edit_counts if len(r) * len(h) <= PLAIN_CELLS else fast_edit_counts)(list(r), list(h)) for r, h in zip(reference, hypothesis)]
    return pd.DataFrame(rows, columns=["hits", "substitutions", "deletions", "insertions"])


def _plain_words(text):
    return F.filter(F.split(F.lower(F.trim(F.coalesce(text, F.lit("")))), r"(?U)\s+"), lambda w: w != "")


def word_edits(pairs, reference="reference", hypothesis="hypothesis"):
    """Edit counts per row; equal texts never reach Python."""
    rows = pairs.withColumns({"__r": _plain_words(F.col(reference)), "__h": _plain_words(F.col(hypothesis))})
    same = F.col("__r") == F.col("__h")
    rows = spread(rows)
    rows = rows.withColumn("e", _edits(F.when(same, F.array().cast("array<string>")).otherwise(F.col("__r")),
                                       F.when(same, F.array().cast("array<string>")).otherwise(F.col("__h"))))
    return rows.withColumns({"hits": F.when(same, F.size("__r").cast("bigint")).otherwise(F.col("e.hits")), "substitutions": F.col("e.substitutions"),
                             "deletions": F.col("e.deletions"), "insertions": F.col("e.insertions")}).drop("__r", "__h", "e")


def word_error_rate(edits):
    """One row over a corpus; the rate is null when there are no reference words."""
    total = edits.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("hits", "substitutions", "deletions", "insertions")])
    words = F.col("hits") + F.col("substitutions") + F.col("deletions")
    return total.withColumn("reference_words", words).withColumn(
        "wer", (F.col("substitutions") + F.col("deletions") + F.col("insertions")) / F.nullif(F.col("reference_words"), F.lit(0)))
