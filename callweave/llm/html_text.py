"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks: the text between block tags, with the path of tags, classes and ids above it. A
bidirectional LSTM in numpy reads, per block, a hashed vector of the path, a hashed vector of the words and a few figures,
and labels every block with the whole page as context. It learns from weak labels: on a bounded sample of pages, blocks under tags or names
that declare their role (article, nav, footer, ...) are examples; part of the sample hides the path, so that words, figures
and neighbours count too.

Cases: null and empty pages give an empty text; unclosed tags, stray brackets and unknown references stay readable; scripts,
styles, comments, titles and what stands in vector images, selections and the like are no blocks; pages of any length are labelled whole; repeated rows are labelled
each; an empty table gives no rows.
"""

import html
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


# Pages whose blocks are learnt from, at most about so many.
TRAINING_PAGES = 600
PATH_SLOTS, WORD_SLOTS, FIGURES, HIDDEN = 48, 32, 8, 16
EPOCHS, BATCH_PAGES, RATE = 12, 24, 0.01
# Cells (pages times longest page) that are labelled together.
CELLS = 60_000

START = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][\w:-]*))")
STOP = re.compile(r"[>\"']")
# Tags whose content is skipped up to their end, or else to the page's (first two) or not at all.
RAW, PLAIN = ("script", "style"), ("title", "textarea", "iframe")
ENDS = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW} | {t: re.compile(rf"<{t}[\s/>]|</{t}\s*>", re.I) for t in PLAIN}
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Fixed lists: tags that stand in a line of text, and tags without an end.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Tags whose content is no text; without an end they are tags like any other.
UNREAD = set("noscript template svg title textarea select iframe object".split())
# Names that declare what a block is, for the weak labels only.
CHROME = re.compile(r"^(?:nav|header|footer|aside|form|button|menu|dialog)$|\b(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|notice\w*|"
                    r"alert|popup|modal|newsletter|subscribe|sidebar|menu|nav\w*|breadcrumb\w*|footer|header|masthead|comment\w*|reply|replies|share|"
                    r"social|related|recommend\w*|login|search|copyright|legal|disclaimer|widget|pagination|toolbar)\b", re.I)
MAIN = re.compile(r"^(?:article|main)$|\b(?:article|content|post|entry|story|body-text|main)\b", re.I)


def tag_end(page, at, dead):
    """The place after the `>` that ends a tag, from a place outside its quotes; -1 where quotes hide every end. `dead` remembers the quotes from
    which no end was reached, so a broken page is read over once and not once per bracket."""
    seen = []
    while True:
        stop = STOP.search(page, at)
        if stop and stop[0] == ">":
            return stop.end()
        close = page.find(stop[0], stop.end()) if stop and stop.start() not in dead else -1
        if stop:
            seen.append(stop.start())
        if close < 0:
            dead.update(seen)
            return -1
        at = close + 1


def marks(page):
    """(start, end, kind, close, tag, rest) of the markup of a page: kind is "tag", "skip" for an element whose content is no text, or "" for comments,
    declarations and tags with broken quotes. A bracket that opens nothing is text."""
    found, dead, last, at = [], set(), page.rfind(">"), 0
    while (at := page.find("<", at)) >= 0:
        if at > last:  # only a comment may still begin
            at = page.find("<!--", at)
            if at >= 0:
                found.append((at, len(page), "", "", "", ""))
            break
        m = START.match(page, at)
        if not m:
            at += 1
            continue
        end, kind, close, tag, rest = -1, "", "", "", ""
        name = (m[4] or "").lower()
        if m[1]:
            stop = page.find("-->", m.end())
            end = stop + 3 if stop >= 0 else len(page)
        elif name in ENDS and not m[3] and page[m.end():m.end() + 1] in (" ", "\t", "\n", "\r", "\f", "\v", "/", ">"):
            stop = ENDS[name].search(page, page.find(">", at) + 1)
            if name in RAW:
                end, kind = stop.end() if stop else len(page), "skip"
            elif stop and page[stop.start() + 1] == "/":
                end, kind = stop.end(), "skip"
        if end < 0 and name:
            end = tag_end(page, m.end(), dead)
            if end >= 0:
                kind, close, tag, rest = "tag", m[3], name, page[m.end():end - 1]
        if end < 0:
            end = page.find(">", at) + 1
        found.append((at, end, kind, close, tag, rest))
        at = end
    return found


def unread(found):
    """{first: last} of the marks that enclose unread content, by their places in the list."""
    opened, ends = {}, {}
    for i, (_, _, _, close, tag, rest) in enumerate(found):
        if tag not in UNREAD:
            continue
        if not close:
            if not (tag == "svg" and rest.endswith("/")):
                opened.setdefault(tag, []).append(i)
        elif opened.get(tag):
            ends[opened[tag].pop()] = i
    return ends


class Path:
    """An open element: its tag, its names, and the element it stands in. What follows from all names above a block is worked out once per element."""

    __slots__ = ("parent", "tag", "names", "known")

    def __init__(self, parent, tag, names):
        self.parent, self.tag, self.names, self.known = parent, tag, names, None

    def facts(self):
        """(slots of all names, whether any declares chrome, whether any declares main text)."""
        chain, node = [], self
        while node is not None and node.known is None:
            chain.append(node)
            node = node.parent
        for element in reversed(chain):
            slots, chrome, main = element.parent.known if element.parent else (np.zeros(PATH_SLOTS, np.float32), False, False)
            slots = slots.copy()
            slots[[slot(name, PATH_SLOTS) for name in element.names]] = 1
            bare = [n.lstrip(".") for n in element.names]
            element.known = slots, chrome or any(map(CHROME.search, bare)), main or any(map(MAIN.search, bare))
        return self.known


NOWHERE = Path(None, "", [])


def blocks(page):
    """[(path, text, share of linked characters)] of a page; a path is the innermost open element."""
    found, top, text, linked, open_ = [], NOWHERE, [], 0, Counter()
    page = page or ""

    def flush():
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            found.append((top, joined, linked / len(joined)))
        text.clear()
        linked = 0

    def say(raw):
        nonlocal linked
        if raw:
            plain = html.unescape(raw) if "&" in raw else raw
            text.append(plain)
            if open_["a"]:
                linked += len(plain.strip())

    def leave():
        nonlocal top
        open_[top.tag] -= 1
        top = top.parent

    at, listed, skipped = 0, marks(page), -1
    ends = unread(listed)
    for i, (start, end, kind, close, tag, rest) in enumerate(listed):
        if i <= skipped:
            continue
        say(page[at:start])
        at = end
        if not tag:
            if kind == "skip":
                flush()
            continue
        if i in ends:
            flush()
            skipped, at = ends[i], listed[ends[i]][1]
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if close:
            if open_[tag]:
                while top.tag != tag:
                    leave()
                leave()
        else:
            if tag not in INLINE:  # a block ends an open paragraph and what stands in its line
                while top.tag in INLINE or top.tag == "p":
                    leave()
            if tag not in VOID and not rest.endswith("/"):
                names = [tag]
                for a, b, c in NAMES.findall(rest):
                    names += ["." + n for n in re.split(r"[\s_-]+", (a or b or c).lower()) if n]
                top = Path(top, tag, names)
                open_[tag] += 1
    say(page[at:])
    flush()
    return found


def slot(name, n):
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % n


def vectors(page_blocks):
    """One row of features per block."""
    x = np.zeros((len(page_blocks), PATH_SLOTS + WORD_SLOTS + FIGURES), np.float32)
    for i, (path, text, linked) in enumerate(page_blocks):
        x[i, :PATH_SLOTS] = path.facts()[0]
        words = text.lower().split()
        x[i, PATH_SLOTS:PATH_SLOTS + WORD_SLOTS] = np.bincount([slot(w, WORD_SLOTS) for w in words], minlength=WORD_SLOTS)
        w = x[i, PATH_SLOTS:PATH_SLOTS + WORD_SLOTS]
        w /= max(1e-6, float(np.sqrt((w * w).sum())))
        x[i, PATH_SLOTS + WORD_SLOTS:] = (1, np.log1p(len(words)) / 5, linked, np.log1p(len(page_blocks)) / 5, i / len(page_blocks),
                                          sum(c in ".,;:!?" for c in text) / len(words), "©" in text or "|" in text, text[-1] in ".!?…:\"”»")
    return x


def weak_labels(page_blocks):
    """1 for main text, 0 for the rest, by declared roles; without any, long blocks with few links are main text."""
    chrome = [path.facts()[1] for path, _, _ in page_blocks]
    main = [path.facts()[2] for path, _, _ in page_blocks]
    if not any(m and not c for m, c in zip(main, chrome)):
        main = [len(t.split()) >= 10 and linked < 0.5 for _, t, linked in page_blocks]
    return np.array([m and not c for m, c in zip(main, chrome)], np.float32)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Lstm:
    """One direction of the labeller; sequences are padded at the end and masked."""

    def __init__(self, width, rng):
        self.w = rng.normal(0, 0.1, (width + HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN:2 * HIDDEN] = 1  # remember at first

    def forward(self, x, mask, keep=False):
        """x (pages, blocks, width) to hidden states (pages, blocks, HIDDEN)."""
        pages, length, _ = x.shape
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((pages, length, HIDDEN), np.float32)
        given = x @ self.w[:x.shape[2]] + self.b
        again, steps = self.w[x.shape[2]:], []
        for t in range(length):
            z = given[:, t] + h @ again
            i, f, o = np.split(sigmoid(z[:, :3 * HIDDEN]), 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t, None]
            now = f * c + i * g
            tc = np.tanh(now)
            if keep:
                steps.append((h, c, i, f, o, g, tc, m))
            h, c = m * (o * tc) + (1 - m) * h, m * now + (1 - m) * c
            out[:, t] = h
        return out, steps

    def backward(self, x, steps, d_out):
        """Gradients of w and b."""
        d_h = np.zeros_like(d_out[:, 0])
        d_c, d_z = np.zeros_like(d_h), np.zeros((*d_out.shape[:2], 4 * HIDDEN), np.float32)
        again = self.w[x.shape[2]:]
        d_again = np.zeros_like(again)
        for t in range(d_out.shape[1] - 1, -1, -1):
            h, c, i, f, o, g, tc, m = steps[t]
            d_h = d_h + d_out[:, t]
            now = m * (d_h * o * (1 - tc * tc) + d_c)
            z = np.concatenate([now * g * i * (1 - i), now * c * f * (1 - f), m * d_h * tc * o * (1 - o), now * i * (1 - g * g)], 1)
            d_z[:, t] = z
            d_again += h.T @ z
            d_h = z @ again.T + (1 - m) * d_h
            d_c = now * f + (1 - m) * d_c
        return np.concatenate([np.einsum("btx,btz->xz", x, d_z), d_again]), d_z.sum((0, 1))


def turned(a, lengths):
    """Each sequence back to front, padding left at the end."""
    at = np.arange(a.shape[1])[None, :]
    index = np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)
    return np.take_along_axis(a, index.reshape(*index.shape, *[1] * (a.ndim - 2)), 1)


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed=0):
        rng = np.random.default_rng(seed)
        width = PATH_SLOTS + WORD_SLOTS + FIGURES
        self.there, self.back = Lstm(width, rng), Lstm(width, rng)
        self.v, self.a = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)

    def padded(self, pages):
        lengths = np.array([len(p) for p in pages])
        x = np.zeros((len(pages), lengths.max(), pages[0].shape[1]), np.float32)
        for i, p in enumerate(pages):
            x[i, :len(p)] = p
        return x, lengths, (np.arange(x.shape[1])[None, :] < lengths[:, None]).astype(np.float32)

    def states(self, x, lengths, mask, keep=False):
        a, left = self.there.forward(x, mask, keep)
        b, right = self.back.forward(turned(x, lengths), mask, keep)
        return np.concatenate([a, turned(b, lengths)], 2), left, right

    def scores(self, pages):
        """Probability of main text for every block of each page; pages are batched by length."""
        out, order = [None] * len(pages), sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        while order:
            most = 1
            while most < len(order) and (most + 1) * len(pages[order[most]]) <= CELLS:
                most += 1
            part, order = order[:most], order[most:]
            x, lengths, mask = self.padded([pages[i] for i in part])
            states, _, _ = self.states(x, lengths, mask)
            p = sigmoid(states @ self.v + self.a)
            for k, i in enumerate(part):
                out[i] = p[k, :lengths[k]]
        return [np.zeros(0, np.float32) if p is None else p for p in out]

    def fit(self, pages, labels, seed=0):
        rng = np.random.default_rng(seed)
        params = [self.there.w, self.there.b, self.back.w, self.back.b, self.v, self.a]
        first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), BATCH_PAGES):
                part = order[at:at + BATCH_PAGES]
                x, lengths, mask = self.padded([pages[i] for i in part])
                x[rng.random(len(part)) < 0.25, :, :PATH_SLOTS] = 0  # some pages hide their paths
                y = np.zeros(mask.shape, np.float32)
                for k, i in enumerate(part):
                    y[k, :lengths[k]] = labels[i]
                states, left, right = self.states(x, lengths, mask, keep=True)
                d = (sigmoid(states @ self.v + self.a) - y) * mask / mask.sum()
                d_states = d[..., None] * self.v
                g_there = self.there.backward(x, left, d_states[..., :HIDDEN])
                g_back = self.back.backward(turned(x, lengths), right, turned(d_states[..., HIDDEN:], lengths))
                t += 1
                for p, g, m, v in zip(params, [*g_there, *g_back, np.einsum("bt,bth->h", d, states), np.array([d.sum()])], first, second):
                    g = np.clip(g, -1, 1)
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        return self


def fit(pages, page_html="html"):
    """A labeller trained on about TRAINING_PAGES distinct pages, those of the smallest hashes; None where no page has a block."""
    texts = pages.where(F.col(page_html).isNotNull()).select(page_html, F.xxhash64(F.lit("draw"), page_html).alias("__draw"))

    def examples(batches):
        for batch in batches:
            made = [b for b in map(blocks, batch[page_html]) if b]
            yield pd.DataFrame({"x": [vectors(b).tobytes() for b in made], "y": [weak_labels(b).tobytes() for b in made]})

    held, size, places = [], TRAINING_PAGES, None
    # Pages without a block give no example: then the draw goes on to more pages.
    while not held and (places is None or places == size // 8):
        draws = texts.select("__draw").distinct().orderBy("__draw").limit(size)
        last = draws.agg(F.max("__draw").alias("last"), F.count("*").alias("n")).first()
        places = last["n"]
        if places:
            drawn = texts.where(F.col("__draw") <= F.lit(last["last"])).select(page_html).distinct()
            held = drawn.mapInPandas(examples, "x binary, y binary").limit(2 * TRAINING_PAGES).collect()
        size *= 8
    if not held:
        return None
    width = PATH_SLOTS + WORD_SLOTS + FIGURES
    held = sorted((bytes(r["x"]), bytes(r["y"])) for r in held)
    return Labeller().fit([np.frombuffer(x, np.float32).reshape(-1, width) for x, _ in held], [np.frombuffer(y, np.float32) for _, y in held])


def extractor(labeller):
    """A column function: the main text of a page."""
    def run(pages: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(pages), 500):
            made = [blocks(p) for p in pages.iloc[at:at + 500]]
            scores = labeller.scores([vectors(b) for b in made]) if labeller else [np.zeros(len(b)) for b in made]
            out += [" ".join(t for (_, t, _), s in zip(b, p) if s >= 0.5) for b, p in zip(made, scores)]
        return pd.Series(out, dtype="object", index=pages.index)
    return pandas_udf(run, StringType())


def with_text(pages, page_html="html", column="text"):
    return pages.withColumn(column, extractor(fit(pages, page_html))(F.col(page_html)))


def report(pages):
    out = with_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
