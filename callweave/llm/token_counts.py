"""Token counts of a unigram tokenizer without its tokens: count-only Viterbi.

An Aho-Corasick automaton lists every vocabulary piece that ends at a position; dynamic programming keeps, per position, the
best score and how many pieces reach it. Nothing else is kept, so a word of any length needs memory for the longest piece
only. Ties go as in the tokenizer: of equal scores the piece that starts first wins, and a character that no single piece
covers is an unknown of (least score - 10), tried last. Pieces never cross the mark at a word's start, so words are counted
one by one and remembered.

Cases: null and empty texts have no tokens; spaces (and only they) separate words, each of several spaces being a word of
its own; a text is never cut; repeated rows are counted each; extra columns pass through.
"""

import ahocorasick
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

MARK, UNKNOWN_PENALTY = "▁", 10.0
# Words whose counts a Python worker remembers before it starts anew.
REMEMBERED = 400_000


def pieces_of(path):
    """(piece, score) of every id of a sentencepiece model file."""
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.vocab_size())]


class UnigramCounter:
    """Counts for a vocabulary of (piece, score). With bytes_fallback an unknown character counts as many tokens as it has
    UTF-8 bytes; otherwise a run of unknowns is one token."""

    def __init__(self, vocabulary, bytes_fallback=True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.longest = max(len(piece) for piece, _ in vocabulary)
        self.bytes_fallback, self.known = bytes_fallback, {}
        self.singles = {piece for piece, _ in vocabulary if len(piece) == 1}

    def word(self, word):
        """Pieces on the best path through a word, the mark included. The ring holds (score, pieces, ends in an unknown)."""
        ring = self.longest + 1
        score, pieces, open_ = [0.0] * ring, [0] * ring, [False] * ring
        found = self.automaton.iter(word)
        end, match = next(found, (-1, None))
        for i, char in enumerate(word):
            here = (i + 1) % ring
            best = None
            while end == i:  # longest first: the earliest start wins ties
                length, gain = match
                at = (i + 1 - length) % ring
                total = score[at] + gain
                if best is None or total > best:
                    best, score[here], pieces[here], open_[here] = total, total, pieces[at] + 1, False
                end, match = next(found, (-1, None))
            if char not in self.singles:
                at = i % ring
                total = score[at] + self.unknown
                if best is None or total > best:
                    more = len(char.encode("utf-8", "surrogatepass")) if self.bytes_fallback else 0 if open_[at] else 1
                    score[here], pieces[here], open_[here] = total, pieces[at] + more, True
        return pieces[len(word) % ring]

    def text(self, text):
        """Tokens of a text whose spaces become marks, with one mark before it."""
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        words = (marked[1:] if marked[0] == MARK else marked).split(MARK)
        known = self.known
        for word in set(words):
            if word not in known:
                known[word] = self.word(MARK + word)
        total = sum(map(known.__getitem__, words))
        if len(known) > REMEMBERED:
            known.clear()
        return total


_COUNTERS = {}


def counts(path, bytes_fallback=True):
    """A column function: tokens of a text under the vocabulary in `path`, a sentencepiece model file."""
    def run(texts: pd.Series) -> pd.Series:
        if path not in _COUNTERS:  # kept from task to task
            _COUNTERS[path] = UnigramCounter(pieces_of(path), bytes_fallback)
        return pd.Series(map(_COUNTERS[path].text, texts), dtype="int64", index=texts.index)
    return pandas_udf(run, LongType())


def with_token_counts(docs, path, text="text", column="n_tokens"):
    return docs.withColumn(column, counts(path)(F.col(text)))


def report(docs):
    import public_tokenizers
    return with_token_counts(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", "n_tokens")
