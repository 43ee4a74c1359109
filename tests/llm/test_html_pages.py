"""Pages with custom elements and unclosed tags, and tables of copies."""

import time

import pytest

from callweave.llm import html_text

from .test_text_operators import PAGE


def said(page):
    return " ".join(t for _, t, _ in html_text.blocks(page))


@pytest.mark.parametrize("tag", [
    "<svg-icon name=x></svg-icon>", "<select-box></select-box>", "<object-card/>", "<template-x></template-x>", '<svg width="1"/>', "<svg/>", "<select>",
    "<svg>", "<object>", "<svg viewBox=0>", "<template>", "<noscript>", "<script-x>", "<style-guide>", "<iframe>", "<textarea>"])
def test_text_after_a_tag_is_read(tag):
    assert said(f"<p>before</p>{tag}<article><p>the article</p></article><svg><text>no</text></svg><p>after</p>") == "before the article after"


def test_enclosed_content_is_not_read():
    for page in ("<svg><svg><text>no</text></svg><text>no</text></svg>", "<select><option>no</select>", "<object><object>no</object>no</object >", "<script>var a;",
                 "<style>p {}", "<!-- no", "<title>no <script> no</title>", "<TEMPLATE><p>no</TEMPLATE>", "<noscript><p>no</noscript>", "<svg><script>'</svg>'</script>no</svg>"):
        assert said(f"<p>yes</p>{page}") == "yes", page


def draw(spark, monkeypatch, pages):
    seen = []
    monkeypatch.setattr(html_text.Labeller, "fit", lambda self, x, y: seen.append(len(x)) or self)
    made = html_text.fit(spark.createDataFrame([(p,) for p in pages], "html string"))
    return made, seen


def test_training_pages_are_drawn_from_distinct_texts(spark, monkeypatch):
    monkeypatch.setattr(html_text, "TRAINING_PAGES", 20)
    copies = [PAGE % (i, "text") for i in range(30) for _ in range(100)]
    assert draw(spark, monkeypatch, copies)[1] == [20]
    assert draw(spark, monkeypatch, copies[:500])[1] == [5]
    assert draw(spark, monkeypatch, [" " * i for i in range(1, 1000)] + [copies[0]])[1] == [1]
    assert draw(spark, monkeypatch, [None, "", " "])[0] is None and draw(spark, monkeypatch, [])[0] is None


@pytest.mark.parametrize("page, n", [("<b" * 2_000_000, 1), ('<b ">"' * 700_000, 1), ("<div>x" * 100_000, 100_000), ("<!x " * 1_000_000, 1), ("<title>x" * 300_000, 300_000), ("<" * 4_000_000, 1)])
def test_broken_and_deep_pages_take_time_in_proportion(page, n):
    start = time.time()
    found = html_text.blocks(page)
    html_text.vectors(found[:2000])
    html_text.weak_labels(found)
    assert time.time() - start < 12 and len(found) == n
