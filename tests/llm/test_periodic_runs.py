"""Periodic runs against a plain search over all lags."""

import random
import time
import zlib
from hashlib import sha256

import pytest

from callweave.llm import periodic_runs

DOCS = "doc_id long, text string"


def plain_runs(w, least=12):
    """Every maximal stretch by trying all lags, and its least period by trying all smaller ones."""
    n, found = len(w), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if j > i and length >= max(least, 2 * q):
                stretch = w[start:j]
                if not any(all(stretch[k] == stretch[k - d] for k in range(d, length)) for d in range(1, q)):
                    found.append((start, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic(rng, letters):
    """Random words with random repeated pieces, some nested."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        piece = [rng.randrange(letters) for _ in range(rng.randrange(1, 14))]
        if rng.random() < 0.4:
            piece = piece * rng.randrange(1, 4) + [rng.randrange(letters) for _ in range(rng.randrange(3))]
        whole = piece * rng.randrange(1, 7)
        out += whole[:len(whole) - rng.randrange(min(len(piece), 3))]
        if rng.random() < 0.3:
            out += out[rng.randrange(len(out)):]
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 6, 40])
def test_runs_equal_brute_force(letters):
    rng = random.Random(letters)
    several = 0
    for _ in range(400):
        w = periodic(rng, letters)[:160]
        want = plain_runs(w)
        several += len(want) > 1
        assert periodic_runs.find_runs(w) == want, w
    assert letters == 1 or several > 50


def test_runs_of_all_short_binary_words():
    for n in (12, 13):
        for x in range(1 << n):
            w = [x >> i & 1 for i in range(n)]
            assert periodic_runs.find_runs(w) == plain_runs(w)


def test_long_texts_take_time_in_proportion():
    rng = random.Random(5)
    texts = {"one word": [0] * 300_000, "blocks": ([0] * 50 + [1]) * 6000, "prose": [rng.randrange(3000) for _ in range(300_000)],
             "two words": [rng.randrange(2) for _ in range(100_000)], "squares": sum(([i, i + 1] * 12 for i in range(12_000)), [])}
    for name, w in texts.items():
        start = time.time()
        runs = periodic_runs.find_runs(w)
        assert time.time() - start < 20, name
        for s, length, q in runs[:50]:
            assert w[s + q:s + length] == w[s:s + length - q]
    assert periodic_runs.find_runs(texts["one word"]) == [(0, 300_000, 1)]
    assert len(periodic_runs.find_runs(texts["blocks"])) == 6001


def expected(doc_id, text):
    w = [x for x in "".join(" " if c in "\t\n\v\f\r" else c for c in text or "").split(" ") if x]
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (doc_id, len(runs), s, length, q, runs and 1000 * length // q or None, sha256(listed.encode()).hexdigest(),
            sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_report_equals_brute_force(spark, rows):
    rng = random.Random(9)
    docs = [(i, " ".join(f"w{x}" for x in periodic(rng, 30))) for i in range(150)]
    docs += [(i, " ".join(f"é{rng.randrange(90)}" for _ in range(rng.randrange(200)))) for i in range(150, 260)]
    docs += [(300, None), (301, ""), (302, " \t\n "), (303, "a\x0bb\x0ca b x y " * 9), (303, "z " * 40), (303, "z " * 40), (304, "日本\n" * 13)]
    out = periodic_runs.report(spark.createDataFrame(docs, DOCS))
    assert out.dtypes == [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"),
                          ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    assert rows(out) == sorted((expected(*d) for d in docs), key=repr)


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b " * 10, 1, "x")], "doc_id long, text string, runs int, period string")
    out = periodic_runs.with_runs(df).collect()
    assert [(r["start"], r["length"], r["period"]) for r in out[0]["runs"]["runs"]] == [(0, 20, 2)]
    assert bytes(out[0]["runs"]["collapsed"]) == b"a b" and out[0]["period"] == "x"
    assert periodic_runs.report(df).collect()[0]["n_runs"] == 1
    assert periodic_runs.report(spark.createDataFrame([], DOCS)).count() == 0
