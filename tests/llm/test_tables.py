"""Search, shards and the pipeline against brute force."""

import random

import numpy as np

import corpus_pipeline
from callweave.llm import line_dedup, sharding, simhash, topk_search, toxicity

from .test_text_operators import DOCS, decontaminated, words


def test_top_k_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(topk_search, "ROWS_IN_BLOCK", 150)
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(400, 16)) * 0.3).astype(np.float32)
    x[50:120] = x[40]  # many equal vectors: ties by id
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1020, [None] * 16), (1040, [float("nan")] * 16), (1060, [float("inf")] * 16), (None, x[0].tolist()), (20, x[20].tolist())]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>")
    q = np.floor(64 * x.astype(float)).astype(int)
    ids = np.r_[np.arange(400), 20]
    q = np.r_[q, q[20:21]]
    want = []
    for i in range(0, 400, 20):
        s = q @ q[i]
        best = sorted((-int(s[j]), int(ids[j])) for j in range(len(ids)) if ids[j] != i)[:20]
        want += [(i, r, j, -a) for r, (a, j) in enumerate(best, 1)]
    assert rows(topk_search.report(df)) == sorted(want, key=repr)


def test_top_k_of_few_rows(spark, rows):
    df = spark.createDataFrame([(20, [1.0, 2.0]), (1, [0.5]), (2, [])], "vec_id long, embedding array<double>")
    assert rows(topk_search.report(df)) == [(20, 1, 1, 64 * 32), (20, 2, 2, 0)]
    assert topk_search.report(df.limit(0)).count() == 0


def check_shards(out, n_rows):
    assert len(out) == n_rows
    for s in range(8):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    return [sum(r["size"] for r in out if r["shard"] == s) for s in range(8)]


def test_shards_are_near_equal_and_keep_groups(spark):
    rng = random.Random(2)
    docs = [(i, words(rng, rng.randrange(5, 60))) for i in range(1500)] + [(5000 + i, None) for i in range(5)] + [(None, "x"), (1, "y"), (1, "y")]
    docs += [(6000 + i, f"copy {i // 3}") for i in range(90)]
    out = sharding.report(spark.createDataFrame(docs, DOCS)).collect()
    sizes = check_shards(out, len(docs))
    largest = max(len((t or "").encode()) + 1 for _, t in docs)
    assert max(sizes) - min(sizes) <= 0.002 * sum(sizes) / 8 + 2 * largest
    homes = {}
    for r in out:
        homes.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(h) > 1 for h in homes.values()) <= 1


def test_a_group_of_half_of_all_rows_is_cut(spark):
    rng = random.Random(3)
    docs = [(i, "the same text again") for i in range(800)] + [(1000 + i, words(rng, 4)) for i in range(800)]
    sizes = check_shards(sharding.report(spark.createDataFrame(docs, DOCS)).collect(), 1600)
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes)
    check_shards(sharding.report(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], DOCS)).collect(), 3)
    assert sharding.report(spark.createDataFrame([], DOCS)).count() == 0


def test_pipeline_stages_decide_as_their_operators_do(spark, tmp_path):
    rng = random.Random(4)
    items = [(i, words(rng, 14)) for i in range(4)]
    docs = []
    for i in range(240):
        bad = i % 8 == 0
        text = words(rng, 30) + "\n" + ("a line that many documents have " if i % 3 == 0 else words(rng, 9)) + "\n" + words(rng, 30)
        text += " vile scumword vile" if bad else ""
        text += " " + items[i % 4][1] if i % 10 == 7 else ""
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
    near = docs[50][1].split(" ")
    near[3] = "edited"
    docs += [(500, docs[51][1], "en", "s", len(docs[51][1])), (501, " ".join(near), None, None, None), (502, None, "de", "s", None), (503, "", "de", "s", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i in range(0, 240, 2)], "doc_id long, quality int, toxic int")
    for name, table in (("documents", df), ("labels", labels), ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    at, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, str(tmp_path))
        out.write.parquet(f"{tmp_path}/out-{name}")
        seen[name] = (at, at := spark.read.parquet(f"{tmp_path}/out-{name}"))
    for name, (before, after) in list(seen.items())[:-1]:
        assert after.columns == df.columns, name
    ids = {name: {r["doc_id"] for r in after.select("doc_id").collect()} for name, (_, after) in seen.items()}
    assert ids["toxicity"] == {i for i, *_ in docs} - {i for i in range(0, 240, 8)}
    assert ids["line_dedup"] == ids["toxicity"]
    before, after = seen["line_dedup"]
    want = {r["doc_id"]: r["text"] for r in line_dedup.report(before).collect()}
    for r in after.collect():
        assert r["text"] == want[r["doc_id"]] and (r["n_chars"] is None or r["n_chars"] == len(r["text"] or ""))
    before, after = seen["simhash_near_dedup"]
    assert ids["simhash_near_dedup"] == {r["component_id"] for r in simhash.report(before).collect()}
    before, after = seen["benchmark_decontamination"]
    leaks = {r[0] for r in decontaminated([(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()], items) if r[5]}
    assert leaks and ids["benchmark_decontamination"] == {r["doc_id"] for r in before.collect()} - leaks
    assert ids["best_fit_packing"] == ids["benchmark_decontamination"]
    assert toxicity.FOLDS == 5
