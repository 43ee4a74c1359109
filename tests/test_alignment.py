"""Alignment, voting, stitching and timing: plain Python statements of the contracts on generated input, and a few own cases."""

import random
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from callweave.operators import align, consensus as cs
from callweave.operators.claims import heard_share

LEXICON = "river stone maple ladder copper window orbit candle forest mirror basket harbor".split()


def frame(spark, rows, schema="call_id string, segment_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def owners_of(spark, base, other):
    return align.word_owners(align.call_words(frame(spark, base)), align.call_words(frame(spark, other)))


def shares(spark, mine, heard):
    base = [("A", i, t) for i, t in enumerate(mine)]
    owners = owners_of(spark, base, [("A", 0, heard)])
    rows = {r.segment_id: r for r in align.segment_agreement(frame(spark, base), owners).collect()}
    return rows, align.call_agreement(owners).first()["agreement"]


def test_owners_keep_order_meet_equal_words_and_share_gaps_evenly(spark):
    rng = random.Random(21)
    base, other, words = [], [], {}
    for n in range(14):
        a, b = [[rng.choice(LEXICON) for _ in range(rng.randrange(low, 50))] for low in (1, 0)]
        base += [(f"K{n}", i, w) for i, w in enumerate(a)]  # every word is a segment, so an owner is a word
        other.append((f"K{n}", 7, " ".join(b)))
        words[f"K{n}"] = a, b
    found = {}
    for r in owners_of(spark, base, other).collect():
        found.setdefault((r.call_id, r.side), []).append(r)
    for call, (a, b) in words.items():
        mine, theirs = (sorted(found.get((call, side), []), key=lambda r: r.at) for side in ("base", "other"))
        assert [r.word for r in mine] == a and [r.word for r in theirs] == b and {r.turn for r in theirs} <= {7}
        owned = [r.owner for r in theirs]
        assert owned == sorted(owned) and all(0 <= o < len(a) for o in owned)
        met = [r for r in theirs if r.matched]
        assert [r.owner for r in met] == [r.at for r in mine if r.matched] and all(a[r.owner] == r.word for r in met)
        assert not b or met or not set(a) & set(b)
        # Between two met words, the other system's words fall evenly on the words it has there.
        ends = [(-1, -1), *[(r.owner, r.at) for r in met], (len(a), len(b))]
        for (i0, j0), (i1, j1) in zip(ends, ends[1:]):
            shares = Counter(owned[j0 + 1:j1])
            if i1 - i0 > 1 and shares:
                counts = [shares[i] for i in range(i0 + 1, i1)]
                assert sum(counts) == j1 - j0 - 1 and max(counts) - min(counts) <= 1


def test_cutting_a_text_differently_changes_nothing(spark):
    parts = ["Copper ladder, by the window;", "a candle at 12 noon", "and two mirrors."]
    rows, whole = shares(spark, parts, "copper ladder by the window a candle at 12 noon and two mirrors")
    assert whole == 1.0 and {r.agreement for r in rows.values()} == {1.0} and rows[1].other_text == "a candle at 12 noon"


def test_a_changed_word_counts_in_its_segment_only(spark):
    rows, whole = shares(spark, ["maple forest", "orbit stone river basket", "harbor"], "maple forest orbit stones river basket harbor")
    assert [rows[i].agreement for i in range(3)] == [1.0, pytest.approx(3 / 4), 1.0] and whole == pytest.approx(6 / 7)


def test_a_segment_nobody_else_heard(spark):
    rows, whole = shares(spark, ["maple forest", "orbit stone river", "harbor light"], "maple forest harbor light")
    assert (rows[1].agreement, rows[1].char_agreement, rows[1].other_text) == (0.0, 0.0, "") and whole == pytest.approx(4 / 7)


def test_joined_spelling_agrees_by_characters(spark):
    rows, _ = shares(spark, ["sun flower field", "four birds"], "sunflower field four beards")
    assert rows[0].agreement < 1.0 == rows[0].char_agreement and rows[1].char_agreement < 0.9


def test_calls_without_words_agree(spark):
    owners = owners_of(spark, [("A", 0, "maple")], [("A", 0, "maple")])
    got = {r.call_id: r.agreement for r in align.call_agreement(owners, spark.createDataFrame([("A",), ("silent",)], "call_id string")).collect()}
    assert got == {"A": 1.0, "silent": 1.0}


def test_speakers_are_those_of_most_aligned_words(spark):
    base = [("A", 0, "maple forest river"), ("A", 1, "orbit"), ("A", 2, "candle basket")]
    turns = frame(spark, [("A", 0, "left", "maple forest"), ("A", 1, "right", "river orbit candle basket")], "call_id string, turn bigint, speaker string, text string")
    owners = align.word_owners(align.call_words(frame(spark, base)), align.call_words(turns, "turn"))
    assert {r.segment_id: r.speaker for r in align.segment_speakers(owners, turns).collect()} == {0: "left", 1: "right", 2: "right"}


def same_text(a, b):
    a, b = a.replace(" ", ""), b.replace(" ", "")
    return a == b if max(len(a), len(b)) < 12 else SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.9


VOTE = "call_id string, segment_pos bigint, whisper string, gemini string, sarvam string"


def test_votes_equal_the_plain_statement(spark):
    rng = random.Random(22)
    data = []
    for i in range(160):
        text = " ".join(rng.choice(LEXICON) for _ in range(rng.randrange(1, 8)))
        vary = lambda t: t if rng.random() < 0.5 else t[:4] + rng.choice("qz") + t[4 + rng.randrange(2):]
        data.append(("A", i, vary(text), vary(text), rng.choice([vary(text), ""])))
    got = {r.segment_pos: r.outcome for r in cs.vote(frame(spark, data, VOTE)).collect()}
    for _, i, w, g, s in data:
        first, second, rest = same_text(w, g), same_text(w, s), same_text(g, s)
        want = "agreed" if first and second else "majority_whisper" if first or second else "majority_gemini_sarvam" if rest else "disputed"
        assert got[i] == want, (w, g, s)
    assert len(set(got.values())) == 4


def test_consensus_takes_the_chosen_candidate(spark):
    said = [("maple forest",) * 3, ("four birds", "four beards", "four beards"), ("river", "orbit", "candle"), ("stone wall", "stone ball", "stone wall")]
    rows = [("Q", i, *texts, "two" if i == 2 else "one") for i, texts in enumerate(said)]
    placed = cs.place(cs.vote(frame(spark, rows, VOTE + ", speaker string")))
    spans = cs.disputed_segments(placed)
    order = spans.select(cs.candidate_order(F.col("call_id"), F.col("span_id"))).first()[0]
    decisions = frame(spark, [("Q", 0, "ABC"[order.index("gemini")], "typed again", False)], "call_id string, span_id bigint, choice string, text string, unclear boolean")
    roles = frame(spark, [("Q", "one", "agent"), ("Q", "two", "prospect")], "call_id string, speaker string, role string")
    out = sorted(cs.build(placed, spans, decisions, roles).collect(), key=lambda r: r.position)
    assert [(r.source, r.text, r.role, r.dropped) for r in out] == [
        ("agreed", "maple forest", "agent", False), ("majority_gemini_sarvam", "four beards", "agent", False),
        ("resolved_gemini", "orbit", "prospect", False), ("majority_whisper", "stone wall", "agent", False)]
    assert cs.missing_decisions(spans, decisions.limit(0)).count() == 1 and cs.missing_decisions(spans, decisions).count() == 0


def test_candidates_are_shuffled_and_repeatable(spark):
    df = spark.range(30).select(F.lit("Q").alias("c"), F.col("id").alias("s"))
    draw = lambda: [tuple(r[0]) for r in df.orderBy("s").select(cs.candidate_order(F.col("c"), F.col("s"))).collect()]
    first = draw()
    assert first == draw() and len(set(first)) > 2 and {tuple(sorted(o)) for o in first} == {("gemini", "sarvam", "whisper")}


def stitched(spark, pieces):
    rows = [("A", p, t, role, text) for p, turns in enumerate(pieces) for t, (role, text) in enumerate(turns)]
    out = align.stitch(frame(spark, rows, "call_id string, piece bigint, turn bigint, role string, text string")).collect()
    return sorted((r.piece, r.turn, r.role, r.text, r.flag) for r in out)


def test_pieces_cut_from_one_text_come_together_again(spark):
    rng = random.Random(23)
    words = [f"{rng.choice(LEXICON)}{i}" for i in range(400)]
    starts = [0, 90, 190, 290]
    pieces = [[("agent", " ".join(words[a:a + 60])), ("prospect", " ".join(words[a + 60:a + 110]))] for a in starts]
    out = stitched(spark, pieces)
    assert " ".join(r[3] for r in out).split() == words[:400] and all(r[4] is None for r in out)
    assert [r[2] for r in out if r[0] == 0] == ["agent", "prospect"]


def test_short_echoes_do_not_cut(spark):
    out = stitched(spark, [[("agent", "river stone maple ladder copper window orbit candle")], [("agent", "stone maple ladder copper window orbit candle"), ("prospect", "a copper window was not in the plan candle")]])
    assert [r[3] for r in out] == ["river stone maple ladder copper window orbit candle", "a copper window was not in the plan candle"]


def test_pieces_without_overlap_are_flagged_and_kept(spark):
    out = stitched(spark, [[("agent", "river stone")], [("prospect", "candle"), ("agent", "orbit")]])
    assert [(r[3], r[4]) for r in out] == [("river stone", None), ("candle", "join_1_unmatched"), ("orbit", None)]


def test_turns_get_the_time_of_their_first_heard_word(spark):
    passages = frame(spark, [("A", 0, 2.0, "maple forest river"), ("A", 1, 9.5, "candle in a basket")], "call_id string, segment_id bigint, start double, text string")
    turns = frame(spark, [("A", 0, "agent", "Maple forest, river!"), ("A", 1, "prospect", "candle in a basket"), ("A", 2, "agent", "xx yy")], "call_id string, turn bigint, role string, text string")
    got = sorted((r.turn, r.start, r.timed, r.end) for r in align.timed_segments(turns, passages).collect())
    assert got == [(0, 2.0, True, 9.5), (1, 9.5, True, 9.5), (2, 9.5, False, None)]


def test_labels_at_line_starts_open_turns(spark):
    texts = [("A", "Agent: river\nand stone\n\n**Customer:** maple"), ("B", "nobody speaks"), ("C", "before\nCustomer: one\r\n two \nAgent:")]
    got = [(r.call_id, r.turn, r.role, r.text) for r in cs.parse_turns(frame(spark, texts, "call_id string, text string")).orderBy("call_id", "turn").collect()]
    assert got == [("A", 1, "agent", "river and stone"), ("A", 2, "prospect", "maple"), ("C", 1, "prospect", "one two")]


def test_pieces_cover_a_recording_with_overlaps(spark):
    lengths = [1, 599, 600, 640, 1500, 2300, 4000]
    got = {}
    for r in cs.piece_starts(frame(spark, [(str(d), d) for d in lengths], "call_id string, duration_seconds int")).collect():
        got.setdefault(int(r.call_id), []).append(r.start_second)
    for d in lengths:
        starts = sorted(got[d])
        assert starts[0] == 0 and starts[-1] < d <= starts[-1] + 600 and all(b - a < 600 for a, b in zip(starts, starts[1:]))


def test_word_errors_add_up(spark):
    pairs = [("maple forest river stone", "maple river stones"), ("", "orbit"), ("Candle  LIGHT", "candle light"), ("window basket", "")]
    total = align.word_error_rate(align.word_edits(frame(spark, pairs, "reference string, hypothesis string"))).first()
    assert (total.hits, total.substitutions, total.deletions, total.insertions) == (4, 1, 3, 1) and total.wer == pytest.approx(5 / 8)
    nothing = align.word_error_rate(align.word_edits(frame(spark, [("", "orbit")], "reference string, hypothesis string"))).first()
    assert nothing.wer is None


def test_edit_counts_are_least():
    rng = random.Random(24)
    for _ in range(250):
        a, b = [[rng.choice("pqr") for _ in range(rng.randrange(9))] for _ in range(2)]

        @lru_cache(None)
        def least(i, j):
            return i + j if not i or not j else min(least(i - 1, j - 1) + (a[i - 1] != b[j - 1]), least(i - 1, j) + 1, least(i, j - 1) + 1)
        hits, swapped, dropped, added = align.edit_counts(a, b)
        assert swapped + dropped + added == least(len(a), len(b))
        assert (hits + swapped + dropped, hits + swapped + added) == (len(a), len(b)) and hits <= sum((Counter(a) & Counter(b)).values())


def test_a_quote_is_heard_if_its_words_are(spark):
    quotes = frame(spark, [(1, "A", "four copper ladders"), (2, "A", "a purple mirror shop"), (3, "A", "um")], "citation_id bigint, call_id string, quote string")
    heard = frame(spark, [("A", "we sold four copper ladders near the harbor")], "call_id string, text string")
    assert {r.citation_id: r.heard for r in heard_share(quotes, heard).collect()} == {1: True, 2: False, 3: True}


def test_shared_characters_bound_every_ratio(spark):
    rng = random.Random(31)
    pairs = [("".join(rng.choice("abcdé日 ") for _ in range(rng.randrange(30))), "".join(rng.choice("abcdé日 ") for _ in range(rng.randrange(30)))) for _ in range(150)]
    df = frame(spark, pairs, "a string, b string")
    for r in df.select("a", "b", align.shared_characters(F.col("a"), F.col("b")).alias("n")).collect():
        assert r.n == sum((Counter(r.a) & Counter(r.b)).values())
        assert SequenceMatcher(None, r.a, r.b, autojunk=False).ratio() * (len(r.a) + len(r.b)) <= 2 * r.n + 1e-9


def test_the_table_function_cuts_turns_like_the_columns(spark):
    texts = ["Agent: hi\nthere\n\nCustomer: yes", "intro\n**Customer:** a \r\n b\rAgent:\n", "", None, "no label", "Agent: x\x85y  z\nAgent : **  w", " *Agent*: q"]
    df = frame(spark, list(enumerate(texts)), "call_id int, text string")
    cs.register_parse_turns(spark)
    got = spark.sql("select l.call_id, x.* from {df} l, lateral parse_turns(l.text) x", df=df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, cs.parse_turns(df).collect()))


def test_matching_equals_difflib_and_is_not_quadratic_in_places():
    import time
    rng = random.Random(4)
    for _ in range(2000):
        letters = "abcde"[:rng.choice([1, 2, 3, 5])]
        a, b = ("".join(rng.choices(letters, k=rng.randrange(25))) for _ in range(2))
        want = SequenceMatcher(None, a, b, autojunk=False)
        assert align._blocks(a, b) == align._blocks(list(a), list(b)) == want.get_matching_blocks()
        assert align._ratio(a, b) == want.ratio()
    began = time.monotonic()
    assert align._ratio("ab" * 15000, "ab" * 12000) == 2 * 24000 / 54000
    assert time.monotonic() - began < 10


def test_matching_of_long_word_lists():
    import time
    said = ["so", "yes", "well"] * 6000
    began = time.monotonic()
    assert [m.size for m in align._blocks(said, said[:15000])] == [15000, 0]
    assert time.monotonic() - began < 10
