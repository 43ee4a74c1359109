"""Half of all rows being one row: shards stay even, samples bounded."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from callweave.llm import sharding, toxicity

from .test_tables import check_shards
from .test_text_operators import DOCS, words


def test_shards_divide_a_row_that_repeats(spark):
    rng = random.Random(6)
    for same in ((7, "the same text again"), (None, "the same text again")):
        docs = [same] * 800 + [(1000 + i, words(rng, 4)) for i in range(800)]
        sizes = check_shards(sharding.report(spark.createDataFrame(docs, DOCS)).collect(), 1600)
        assert max(sizes) - min(sizes) < 0.02 * sum(sizes)
    check_shards(sharding.report(spark.createDataFrame([same] * 900, DOCS)).collect(), 900)


def test_a_toxic_id_on_half_of_the_rows_does_not_pass_the_bound(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "POSITIVES", 60)
    monkeypatch.setattr(toxicity, "UNLABELLED", 100)
    rng = random.Random(8)
    hot = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5)
    docs = [(hot, "vile scumword vile")] * 1500 + [(hot, f"vile scumword {i}") for i in range(500)] + [(1000 + i, words(rng, 6)) for i in range(2000)]
    labels = [(hot, 1)] + [(1000 + i, int(i % 9 == 0)) for i in range(0, 2000, 2)]
    rows, prior = toxicity.sample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id", "text")
    held = rows.groupBy("positive").agg(F.count("*"), F.countDistinct("text")).collect()
    assert {r[0]: (r[1], r[2]) for r in held} == {True: (60, 60), False: (100, 100)} and 0 < prior < 0.2


def test_a_draw_has_the_full_width_of_its_hash(spark):
    for share in (8000 / 5e9, 8000 / 1e10, 1e-12):
        edge = int(share * 2**64) - 2**63
        df = spark.createDataFrame([(edge - 1,), (edge,), (-(2**63),), (2**63 - 1,)], "h long")
        assert [r[0] for r in df.select(toxicity.below(F.col("h"), share)).collect()] == [True, False, True, False] and edge > -(2**63)
    assert spark.range(3).where(toxicity.below(F.col("id"), 1.0)).count() == 3


def test_the_gradient_of_the_risk_is_its_slope():
    rng = np.random.default_rng(4)
    for prior in (0.05, 0.4, 0.9):
        p, u, w, b = rng.integers(0, 2, (30, 6)), rng.integers(0, 2, (50, 6)), rng.normal(size=6), 0.3
        risk, negative, up, down = toxicity.pu_risk(p, u, w, b, prior)
        gradient = up + (down if negative >= 0 else 0)
        for i in range(7):
            step = np.zeros(7)
            step[i] = 1e-6
            ahead, behind = (toxicity.pu_risk(p, u, w + s * step[:6], b + s * step[6], prior)[0] for s in (1, -1))
            assert abs((ahead - behind) / 2e-6 - gradient[i]) < 1e-6
