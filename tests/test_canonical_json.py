"""JSON text and digests against Python's own."""

import hashlib
import json
import random

from pyspark.sql import functions as F

from callweave.functions.keys import call_key, digest, json_text


def test_text_and_digests_equal_pythons(spark):
    rng = random.Random(5)
    texts = ["", "plain", 'a "quote" and \\ back', "tab\tline\nreturn\rbell\x07\b\f\x00\x1f\x7f", "é ß 日本 Ω", "😀 mixed 🇮🇳 \U0010ffff", "  ﻿", "/slash/"]
    texts += ["".join(chr(rng.choice([rng.randrange(32), rng.randrange(32, 127), rng.randrange(127, 0xD800), rng.randrange(0x10000, 0x20000)])) for _ in range(rng.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for r in df.select("text", json_text(F.col("text")).alias("j"), digest(F.col("text"), "x", 7).alias("d"), call_key(F.col("text")).alias("k")).collect():
        want = json.dumps(r.text)
        assert r.j == want
        assert r.d == hashlib.sha256(json.dumps([r.text, "x", 7]).encode()).hexdigest()
        assert r.k == "C" + hashlib.sha256(want.encode()).hexdigest()[:16]
