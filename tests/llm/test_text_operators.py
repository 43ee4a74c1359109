"""Operators on texts against brute force, other libraries and exact round trips, with nulls, empty and long texts, ties, repeated rows, empty
tables and clashing columns."""

import random
import re
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import xxhash

from callweave.llm import decontamination, html_text, line_dedup, packing, passages, simhash, token_counts, toxicity

DOCS = "doc_id long, text string"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}x{rng.randrange(9)}" for _ in range(n))


# ---- token counts ----

def unigram(vocabulary, fallback):
    from tokenizers import Tokenizer, models, pre_tokenizers
    t = Tokenizer(models.Unigram(vocabulary, 0, fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_token_counts_equal_the_tokenizer():
    vocabulary = token_counts.pieces_of(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(1)
    texts = ["", " ", "  a  b ", "▁x", "a▁▁b", "\n\tline", "日本語 😀😀x", "<s> <0x41>", "x" * 5000]
    texts += ["".join(rng.choice("abe tion.é日☃\n ") for _ in range(rng.randrange(200))) for _ in range(80)]
    count, want = token_counts.UnigramCounter(vocabulary), unigram(vocabulary, True)
    assert [count.text(t) for t in texts] == [want(t) for t in texts]


def test_token_count_ties_take_the_earliest_start():
    vocabulary = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("▁a", -2.0), ("b", -1.0), ("ab", -2.0)]
    count, want = token_counts.UnigramCounter(vocabulary, False), unigram(vocabulary, False)
    for text in ["a", "aa", "aaab", "abab", "ab zz a", "zzazz", "aaaaaaab b"]:
        assert count.text(text) == want(text)


def test_token_counts_of_odd_rows(spark, rows):
    df = spark.createDataFrame([(1, None, 5), (None, "", 6), (2, "hello there", 7), (2, "hello there", 7)], "doc_id long, text string, n_tokens int")
    out = token_counts.with_token_counts(df, public_tokenizers.path("piece_bpe_32k.model"))
    n = unigram(token_counts.pieces_of(public_tokenizers.path("piece_bpe_32k.model")), True)("hello there")
    assert [r["n_tokens"] for r in out.orderBy("n_tokens").collect()] == [0, 0, n, n] and out.columns == df.columns
    assert token_counts.report(spark.createDataFrame([], DOCS)).count() == 0


# ---- toxicity ----

def toxic_tables(spark, n=400):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        docs.append((i, words(rng, 40) + (" vile scumword vile" if bad else "") + " " + words(rng, 10)))
        if i % 2 == 0:
            labels.append((i, int(bad)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_finds_held_out_documents(spark):
    docs, labels = toxic_tables(spark)
    out = toxicity.report(docs, labels).collect()
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] % 6 == 0) for r in held) / len(held) > 0.97


def test_toxicity_of_odd_rows(spark):
    docs, labels = toxic_tables(spark, 200)
    odd = spark.createDataFrame([(None, "vile scumword vile"), (9000, None), (9001, ""), (9001, "")], DOCS)
    marks = labels.unionByName(spark.createDataFrame([(None, 1), (7777, 1), (0, 0), (2, None)], "doc_id long, toxic int"))
    got = [r for r in toxicity.report(docs.unionByName(odd), marks).collect() if r["doc_id"] is None or r["doc_id"] >= 9000]
    assert sorted((r["doc_id"] or 0, r["predicted"]) for r in got) == [(0, 1), (9000, 0), (9001, 0), (9001, 0)]
    no_examples = toxicity.report(docs, labels.where("toxic = 0")).collect()
    assert {r["score"] for r in no_examples} == {0.0}
    assert toxicity.report(docs.limit(0), labels).count() == 0
    kept = toxicity.accepted(docs.selectExpr("*", "1 AS score", "'x' AS predicted"), labels)
    assert kept.columns == ["doc_id", "text", "score", "predicted"] and kept.where("score <> 1").isEmpty() and kept.count() < docs.count()


# ---- repeated passages ----

def best_chain(pos, at, gap, weight):
    order = np.lexsort((-at, pos))
    score = {}
    for i in order:
        before = [score[j] - gap * (pos[i] - pos[j] + at[i] - at[j]) for j in score if pos[j] < pos[i] and at[j] < at[i]]
        score[i] = weight + max([0.0, *before])
    return max(score.values())


def test_chains_equal_the_quadratic_recursion():
    rng = np.random.default_rng(3)
    for _ in range(40):
        n = int(rng.integers(2, 40))
        pos, at = np.sort(rng.choice(200, n, replace=False)), rng.integers(0, 200, n)
        found = passages.chains(pos, at)
        top = best_chain(pos, at, passages.GAP, float(passages.SEED))
        assert (max(s for s, _ in found) if found else passages.SEED) == pytest.approx(top)
        for _, c in found:
            assert (np.diff(pos[c]) > 0).all() and (np.diff(at[c]) > 0).all()


def test_every_repeated_window_lies_in_a_passage(spark):
    rng = random.Random(4)
    shared, fuzzy = words(rng, 70, 5000).split(), words(rng, 90, 5000).split()
    docs = []
    for i in range(40):
        body = words(rng, 120, 5000).split()
        if i % 4 == 0:
            at = rng.randrange(100)
            body[at:at] = shared
        if i % 5 == 1:
            copy = [w if rng.random() > 0.04 else "edit" for w in fuzzy]
            body += copy
        docs.append((i, " ".join(body)))
    docs += [(100 + i, docs[2][1]) for i in range(30)] + [(200, None), (201, ""), (None, docs[2][1]), (202, words(rng, 49)), (2, docs[2][1])]
    out = passages.repeated_passages(spark.createDataFrame(docs, DOCS)).collect()
    found = {}
    for r in out:
        found.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
        found.setdefault(r["partner_id"], []).append((r["partner_start"], r["partner_end"]))
        assert r["doc_id"] != r["partner_id"] and r["end"] - r["start"] >= passages.PASSAGE and r["identity"] >= passages.IDENTITY
    want = {i for i in range(40) if i % 4 == 0 or i % 5 == 1} | {2} | {100 + i for i in range(30)}
    assert set(found) == want
    seen = {}
    for i, t in docs:
        for k in range(len((t or "").split()) - 50):
            seen.setdefault(tuple(t.split()[k:k + 51]), set()).add((i, k))
    for places in seen.values():
        for i, k in places if len({i for i, _ in places if i is not None}) > 1 else ():
            assert i is None or any(a <= k and k + 51 <= b for a, b in found[i])


def test_no_passages_in_empty_or_clean_tables(spark):
    assert passages.report(spark.createDataFrame([], DOCS)).count() == 0
    rng = random.Random(5)
    clean = [(i, "a common first line of nine words stands here. " + words(rng, 200, 90000)) for i in range(20)]
    assert passages.report(spark.createDataFrame(clean, DOCS)).count() == 0


# ---- lines ----

def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_lines_equal_brute_force(spark):
    rng = random.Random(6)
    base = [words(rng, n, 60).split() for n in (4, 5, 6, 6, 9, 14)]
    lines = []
    for _ in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            at, what = rng.randrange(len(w)), rng.randrange(3)
            w[at:at + (what != 0)] = [] if what == 1 else [f"new{rng.randrange(4)}"]
        lines.append("  ".join(w) if rng.random() < 0.2 else " ".join(w))
    lines[5:5], lines[90:90] = ["日本語の行です", "- yes", "one two three four", "  "], ["日本語の行です", "-  yes", "one two three five", "  ", "- no"]
    docs = [(i, "\n".join(lines[i * 8:i * 8 + 8] + [""])) for i in range(21)] + [(50, None), (51, ""), (None, lines[0]), (7, "\n".join(lines[56:64] + [""]))]
    order = sorted({((-1 if i is None else i), n, tuple(x.split())) for i, t in docs if t for n, x in enumerate(t.split("\n"))})
    gone, earlier = set(), []
    for i, n, w in order:
        if w:
            if w in earlier or any(min(len(w), len(v)) >= line_dedup.MIN_WORDS and edits(w, v) <= 1 for v in earlier):
                gone.add((i, n))
            earlier.append(w)
    want = [(i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if ((-1 if i is None else i), n) not in gone)) for i, t in docs]
    out = line_dedup.report(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == sorted(want, key=repr)
    kept = line_dedup.without_repeats(spark.createDataFrame([(i, t, 1, 2) for i, t in docs], DOCS + ", n_lines int, n_chars long"), n_chars="n_chars")
    assert kept.columns == ["doc_id", "text", "n_lines", "n_chars"] and kept.where("n_lines <> 1").isEmpty()
    assert line_dedup.report(spark.createDataFrame([], DOCS)).count() == 0


def test_a_long_line_and_a_family_of_near_lines(spark):
    long_ = " ".join(f"word{i}" for i in range(3000))
    docs = [(0, long_), (1, long_.replace("word1500 ", ""))] + [(10 + i, f"one of many near lines number {i} here") for i in range(300)]
    out = {r["doc_id"]: r["n_removed"] for r in line_dedup.report(spark.createDataFrame(docs, DOCS)).collect()}
    assert out == {0: 0, 1: 1, 10: 0} | {10 + i: 1 for i in range(1, 300)}


# ---- benchmark ----

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def decontaminated(docs, items):
    found = []
    for i, text in docs:
        w, hit, ids = lowered(text), set(), set()
        for item, t in items:
            v = lowered(t)
            size = min(10, len(v))
            for s in range(len(v) - size + 1 if v else 0):
                for p in range(len(w) - size + 1):
                    if w[p:p + size] == v[s:s + size]:
                        hit |= set(range(p, p + size))
                        ids.add(str(item))
        found.append((i, len(w), len(hit), len(ids), sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return found


def test_decontamination_equals_brute_force(spark, rows):
    rng = random.Random(7)
    items = [(i, words(rng, n, 12)) for i, n in enumerate((3, 9, 10, 11, 25, 1, 0))] + [(20, None), (21, "Éa-ß, Z9."), (4, words(rng, 12, 12)), (22, words(rng, 10, 12))]
    docs = [(i, words(rng, 60, 12) + " " + (items[rng.randrange(5)][1]).upper() + " " + words(rng, 5, 12)) for i in range(30)]
    docs += [(40, None), (41, ""), (None, "w Éa ß z9 w"), (3, docs[3][1]), (42, "ÉA ß z9"), (43, items[4][1] * 40)]
    args = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert rows(decontamination.report(*args)) == sorted(decontaminated(docs, items), key=repr)
    extra = args[0].selectExpr("*", "1 AS met", "2 AS key", "3 AS found")
    kept = decontamination.clean(extra, args[1])
    assert kept.columns == extra.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted((r[0] or 0) for r in decontaminated(docs, items) if not r[5])


def test_decontamination_without_items_or_documents(spark):
    docs, items = spark.createDataFrame([(1, "a b c")], DOCS), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [r["contaminated"] for r in decontamination.report(docs, items.limit(0)).collect()] == [False]
    assert decontamination.report(docs.limit(0), items).count() == 0


def test_proximity_matches(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, f"x {item} y"), (2, f"x {item.replace('beta', 'beta extra')} y"), (3, "alpha beta gamma only")]
    out = decontamination.matches(spark.createDataFrame(docs, DOCS), "text", spark.createDataFrame([(5, item)], "item_id long, text string"), slop=2)
    kinds = {r["doc_id"]: {m["kind"] for m in r["found"]} for r in out.collect()}
    assert "phrase" in kinds[1] and kinds[2] == {"near"} and kinds[3] == set()


# ---- simhash ----

def print_of(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components_equal_brute_force(spark):
    rng = random.Random(8)
    docs = []
    for i in range(25):
        base = words(rng, 150, 3000).split()
        docs.append((i * 10, " ".join(base)))
        for j in range(rng.randrange(5)):
            base = list(base)
            base[rng.randrange(150)] = "edit"
            docs.append((i * 10 + j + 1, " ".join(base)))
    docs += [(900, None), (901, ""), (902, " \t"), (903, "one"), (904, "One"), (905, "a b"), (None, docs[0][1]), (0, docs[0][1]), (906, words(rng, 40000))]
    prints = [print_of(t) for _, t in docs]
    group = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for a in range(len(docs)):
            for b in range(a):
                if bin(prints[a] ^ prints[b]).count("1") <= 3 and group[a] != group[b]:
                    group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
                    changed = True
    first = {g: min(i for (i, _), k in zip(docs, group) if k == g and i is not None) for g in set(group)}
    want = sorted(((i, f"{p:016x}", first[g]) for (i, _), p, g in zip(docs, prints, group)), key=repr)
    df = spark.createDataFrame(docs, DOCS)
    out = [tuple(r) for r in simhash.report(df).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(out, key=repr) == want
    kept = simhash.first_of_group(df.selectExpr("*", "1 AS fingerprint", "'c' AS component")).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(first.values()) and {r["component"] for r in kept} == {"c"}
    assert simhash.report(df.limit(0)).count() == 0


def test_long_chains_of_links_are_one_component(spark):
    from callweave.llm.components import components
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (103, 100)], "a long, b long")
    out = {r["node"]: r["component"] for r in components(links).collect()}
    assert len({out[i] for i in range(61)}) == 1 and len({out[i] for i in (100, 101, 103)}) == 1 and out[0] != out[100]


# ---- packing ----

def test_packing_is_an_exact_round_trip(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(9)
    docs = [(i, words(rng, rng.randrange(1, 500))) for i in range(60)] + [(70, None), (71, ""), (72, "x" * 9000), (73, words(rng, 3000)), (None, "It's <|endoftext|> ok"), (5, "tie"), (5, "tie")]
    docs += [(80, "İstanbul's THE,the. <|ENDOFTEXT|>x, é», 12. 3,4 e\u0301tait don't!? \xa0a\x85b ''s"), (81, "ﬁn ÀÉ. x<|endoftext|>, Ǆ ŉ")]
    out = [r.asDict() for r in packing.pack(spark.createDataFrame(docs, DOCS), path).collect()]
    t = Tokenizer.from_file(path)
    want = []
    for i, text in docs:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i, k, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out), key=repr) == sorted(want, key=repr)
    held = {}
    for r in out:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist() and sum(n for _, n in parts) <= 2048
    total = sum(r["length"] for r in out)
    assert len(held) <= -(-total // 2048) + 1
    assert packing.report(spark.createDataFrame([], DOCS)).count() == 0


def test_plans_use_every_piece_and_are_no_worse_than_best_fit():
    rng = np.random.default_rng(10)
    for scale, capacity in ((3, 64), (50, 64), (2000, 256)):
        counts = rng.integers(0, scale, capacity + 1)
        counts[0] = 0
        runs = packing.plan(counts, capacity)
        used = np.zeros_like(counts)
        for content, times in runs:
            assert sum(n * k for n, k in content) <= capacity
            for n, k in content:
                used[n] += k * times
        assert (used == counts).all()
        assert sum(t for _, t in runs) <= sum(t for _, t in packing.best_fit(counts, capacity))


# ---- web pages ----

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><nav><ul><li><a href=/a>Home</a></li></ul></nav></header><div class="ad">Buy things now.</div>
<article><h1>Title&nbsp;of &lt;it&gt;</h1><p>First <b>bo</b>ld &amp; text %d.<p>Second &eacute;   line<br>goes on %s.</p></article>
<div class="comments"><p>Nice post, said a reader.</p></div><footer>&copy; site &middot; All rights.</footer></body></html>"""


def test_html_extraction(spark):
    rng = random.Random(11)
    pages = [(i, f"u{i}", PAGE % (i, words(rng, 30))) for i in range(40)]
    want = {i: f"Title of <it> First bold & text {i}. Second é line goes on " + h.split("goes on ")[1].split(".</p>")[0] + "." for i, _, h in pages}
    odd = [(100, None, None), (101, "u", ""), (3, "u3", pages[3][2]), (102, "u", "<article><p>unclosed <b>text &bogus; < 5"), (None, "u", "<nav>x</nav>")]
    out = html_text.report(spark.createDataFrame(pages + odd, "page_id long, url string, html string")).collect()
    got = {r["page_id"]: r["text"] for r in out if r["page_id"] is not None and r["page_id"] < 100}
    assert got == want and len(out) == 45
    by = {r["page_id"]: r for r in out}
    assert by[100]["text"] == by[101]["text"] == "" and by[100]["n_chars"] == 0 and by[102]["text"] == "unclosed text &bogus; < 5"
    assert by[3]["n_chars"] == len(want[3])
    assert html_text.report(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_labeller_gradients():
    rng = np.random.default_rng(12)
    net = html_text.Lstm(5, rng)
    net.w, net.b = net.w.astype(float), net.b.astype(float)
    x, mask = rng.normal(size=(2, 4, 5)), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], float)
    goal = rng.normal(size=(2, 4, html_text.HIDDEN))
    _, steps = net.forward(x, mask, keep=True)
    g_w, g_b = net.backward(x, steps, goal)
    for array, grad, at in ((net.w, g_w, (1, 7)), (net.w, g_w, (8, 40)), (net.b, g_b, (20,))):
        old = array[at]
        array[at] = old + 1e-3
        up = (net.forward(x, mask)[0] * goal).sum()
        array[at] = old - 1e-3
        down = (net.forward(x, mask)[0] * goal).sum()
        array[at] = old
        assert grad[at] == pytest.approx((up - down) / 2e-3, abs=2e-3)
