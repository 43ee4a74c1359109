"""The mix of sources against a plain count of every word taken."""

import hashlib
import random
import re

import pytest

from callweave.llm import mixing

DOCS = "doc_id long, text string, source string"


def plain(docs):
    """Sizes, targets by repeated sharing, and each document's words in the first `target` words of its source's endless shuffled text."""
    sized = [(d, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s, hashlib.md5(f"{'' if d is None else d}|{t or ''}".encode()).hexdigest()) for d, t, s in docs]
    names = sorted({s for *_, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    whole = {s: sum(n for _, n, x, _ in sized if x == s) for s in names}
    total, target, free = sum(whole.values()), {}, set(names)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if 3 * whole[s] < level * weight[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 3.0 * whole[s] for s in over}
        free -= over
    out = []
    for s in names:
        at, need = 0, int(target[s] + 0.5)
        for d, n, _, _ in sorted((r for r in sized if r[2] == s), key=lambda r: r[3]):
            out.append((d, n, whole[s], round(target[s], 6), sum(max(0, min(n, need - e * whole[s] - at)) for e in range(3))))
            at += n
    return sorted(out, key=repr)


def corpus(seed, n=400):
    rng = random.Random(seed)
    docs = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([1, 5, 30, 200]))), rng.choice(["a", "a", "a", "a", "b", "Z", "é", None, "c" if i % 40 == 0 else "a"])) for i in range(n)]
    return docs + [(900, None, "a"), (901, "", "b"), (902, " \t\n", None), (903, "x\x0by\x0cz", "tiny"), (None, "u v", "b"), (904, None, "empty"),
                   (905, "long " * 20_000, "a"), *[(7, "the same row", "b")] * 30, *[(8, "", "b")] * 3]


def report_of(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mixing.report(df).collect()), key=repr)


@pytest.mark.parametrize("block", [16, 512])
def test_mix_equals_plain_count(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    monkeypatch.setattr(mixing.mixed, "__defaults__", tuple(block if v == 512 else v for v in mixing.mixed.__defaults__))
    monkeypatch.setattr(mixing, "COPIES_TOGETHER", 7)
    docs = corpus(block)
    assert report_of(spark.createDataFrame(docs, DOCS)) == plain(docs)
    assert report_of(spark.createDataFrame(docs[::-1], DOCS).repartition(5)) == plain(docs)


def test_every_stretch_of_slots_holds_the_sources_in_proportion(spark):
    rng = random.Random(3)
    docs = [(i, "w " * rng.randrange(1, 300), f"s{rng.choice([0, 0, 0, 1, 2, 3])}") for i in range(900)]
    _, shares, pieces = mixing.mixed(spark.createDataFrame(docs, DOCS), block=64)
    shares = {r["no"]: r["target"] for r in shares.collect()}
    total, slots = sum(shares.values()), sorted((r["slot"], r["no"], r["place"], r["n_words"], r["doc_id"], r["doc_word"]) for r in pieces.collect())
    owner = {s: no for s, no, *_ in slots}
    order = sorted(owner)
    for size in (50, 200, 1000):
        for at in range(0, len(order) - size, size):
            for no, target in shares.items():
                assert abs(sum(owner[s] == no for s in order[at:at + size]) - size * target / total) < 6
    # Pieces fill their slot from its first word on without gaps, and only the last slots of a source may be short.
    at = {}
    for slot, no, place, n, doc_id, word in slots:
        assert place == at.get(slot, 0) and word + n <= len(docs[doc_id][1].split())
        at[slot] = place + n
    assert sum(n < 64 for n in at.values()) <= 4 * len(shares) and max(at.values()) == 64


def test_odd_tables(spark):
    assert mixing.report(spark.createDataFrame([], DOCS)).count() == 0
    assert report_of(spark.createDataFrame([(1, None, None), (2, " ", "a")], DOCS)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    df = spark.createDataFrame([(1, "a b", "s", 1, 2, "x")], DOCS + ", size int, no int, slot string")
    assert report_of(df) == [(1, 2, 2, 2.0, 2)]
