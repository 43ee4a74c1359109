"""The pipeline's near copies against the exact similarity of all pairs."""

import random

import corpus_pipeline

from .test_text_operators import words


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def test_the_stage_keeps_one_of_planted_near_copies(spark):
    rng, docs = random.Random(1), []
    for i in range(40):
        base = words(rng, rng.choice([60, 150, 600]), 5000).split()
        docs.append((10 * i, " ".join(base)))
        for j in range(1, 5):
            copy = list(base)
            for k in rng.sample(range(len(copy)), rng.randrange(1, max(2, len(copy) // 30) + 1)):
                copy[k] = f"edit{i}x{j}x{k}"
            docs.append((10 * i + j, " ".join(copy)))
    docs += [(900, None), (901, ""), (902, "a b"), (903, "A  b"), (904, "a c"), (0, docs[0][1]), (None, docs[5][1]), (None, "no id")]
    group, found = list(range(len(docs))), [sets(t) for _, t in docs]
    for a in range(len(docs)):
        for b in range(a):
            if len(found[a] & found[b]) >= 0.8 * len(found[a] | found[b]) and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    want = sorted((min((i for (i, _), k in zip(docs, group) if k == g and i is not None), default=-1) for g in set(group)))
    out = corpus_pipeline.keep_one_of_near_copies(spark, spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, node int"), None)
    assert out.columns == ["doc_id", "text", "node"]
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in out.collect()) == want
    assert corpus_pipeline.keep_one_of_near_copies(spark, spark.createDataFrame([], "doc_id long, text string"), None).count() == 0


def test_pairs_inside_a_family_of_near_misses_are_linked(spark):
    """Planted pairs over the threshold among many texts just under it, which share their buckets: groups equal those of all pairs."""
    from callweave.llm import near_copies
    from callweave.llm.components import components
    rng, docs = random.Random(3), []
    base = words(rng, 300, 5000).split()
    for i in range(60):
        first = list(base)
        for k in rng.sample(range(300), 10):
            first[k] = f"own{i}x{k}"
        second = list(first)
        for k in rng.sample(range(300), 5):
            second[k] = f"pair{i}x{k}"
        docs += [" ".join(first), " ".join(second)]
    found = [sets(t) for t in docs]
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if len(found[a] & found[b]) >= 0.8 * len(found[a] | found[b]) and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    nodes = [r.node for r in df.orderBy("doc_id").select(near_copies.node(df["text"]).alias("node")).collect()]
    named = {r.node: r.component for r in components(near_copies.links(df, "text")).collect()}
    got = [named.get(n, n) for n in nodes]
    assert len(set(group)) > 20
    assert [got.index(g) for g in got] == [group.index(g) for g in group]
