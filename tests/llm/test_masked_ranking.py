"""Ranked search by presence masks against scores of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from callweave.llm import masked_ranking

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, k=20):
    held = [(d, Counter(ws), len(ws)) for d, t in docs if (ws := words(t))]
    n, total = len(held), sum(c for _, _, c in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in items:
        asked, scored = Counter(words(text)), []
        for d, counts, length in held:
            m = 75 + 25 * length * n // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * counts[w] // (1000 * counts[w] + 12 * m))
                    for w, q in asked.items() if w in counts)
            if s > 0:
                scored.append((-s, d is None, d))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    share = [1 / (i + 1) for i in range(120)]
    docs = [(i, " ".join(rng.choices(vocabulary, share, k=rng.choice([3, 10, 40, 200])))) for i in range(n)]
    items = [(i, " ".join(rng.choices(vocabulary, [s ** 0.3 for s in share], k=rng.choice([1, 4, 20, 90])))) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("block", [7, 64, 8192])
def test_ranks_equal_brute_force(spark, rows, monkeypatch, block):
    monkeypatch.setattr(masked_ranking, "DOCS_IN_BLOCK", block)
    docs, items = corpus(block)
    docs += [(1000 + i, docs[5][1]) for i in range(40)]  # ties
    docs += [(900, docs[5][1]), (900, docs[5][1]), (None, docs[5][1]), (901, None), (902, ""), (903, "--- !"), (904, "W1 w1, É w2 x"), (905, "w3 " * 50_000)]
    items += [(50, docs[5][1]), (50, docs[5][1]), (51, None), (52, ""), (53, "nowhere"), (None, "w3 É"), (54, "w1 w1 w1 W1")]
    out = masked_ranking.report(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS))
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert rows(out) == plain(docs, items)


def test_masks_of_many_terms_and_early_stop():
    rng = np.random.default_rng(3)
    postings = {}
    for t in range(150):
        docs = np.flatnonzero(rng.random(3000) < 1 / (1 + t / 4)).astype(np.int32)
        postings[b"%d" % t] = docs, rng.integers(1, 9, len(docs))
    lengths = rng.integers(5, 500, 3000)
    search = masked_ranking.BlockSearch(lengths, postings, 10_000, 10_000 * 120)
    weighted = [(b"%d" % t, int(rng.integers(0, 9000))) for t in range(150)] + [(b"absent", 5)]
    for some in (weighted, weighted[:64], weighted[:65], weighted[:3]):
        score = np.zeros(3000, np.int64)
        for t, w in some:
            if t in postings:
                docs, times = postings[t]
                score[docs] += w * (10**9 * times // (1000 * times + 12 * search.norm[docs]))
        order = [i for i in np.lexsort((np.arange(3000), -score))[:20] if score[i] > 0]
        places, scores = search.best(some, 20)
        assert places.tolist() == order and scores.tolist() == score[order].tolist()
        floor = int(score[order[9]])
        places, scores = search.best(some, 20, floor)
        assert [p for p, s in zip(places, scores) if s >= floor][:10] == order[:10]


def test_odd_tables(spark):
    docs, items = spark.createDataFrame([("a", "x y", 1), (None, "x", 2)], "doc_id string, text string, score int"), spark.createDataFrame([(1, "x", 3)], "item_id long, text string, term int")
    # Both hold x: its weight is floor(1000 ln(6 / 5)); the shorter document scores higher.
    assert [(r["doc_id"], r["rank"]) for r in masked_ranking.report(docs, items).orderBy("rank").collect()] == [(None, 1), ("a", 2)]
    assert masked_ranking.report(docs.limit(0), items).count() == 0
    assert masked_ranking.report(docs, items.limit(0)).count() == 0
