"""Names as they are used on the web, broken and deep markup, and the style tree against plain Python."""

import math
import random
import time
from collections import Counter, defaultdict

import pytest

from ledgerleaf.llm import page_text

SCHEMA = "page_id long, url string, html string, text string, host string, zone int"


def kept(html):
    return [b[3] for b in page_text.parse(html).blocks]


def test_names_that_only_contain_a_noise_word():
    pieces = "".join(f'<div class="elementor-widget-text"><p>Part {k}</p></div>' for k in range(4))
    assert kept(f"<body>{pieces}</body>") == [f"Part {k}" for k in range(4)]
    assert kept('<article><p>x</p><section class="related-work">other work</section></article>') == ["x", "other work"]
    assert page_text.noise_words("site-footer ad-box elementor-widget has-sidebar related-work no-ads search-results comments-open") == {"footer", "ad"}
    assert page_text.noise_words("widget widget_text main-nav-links sidebar2 post-comments") == {"widget", "nav", "sidebar", "comments"}


def test_a_header_within_main_is_judged_by_its_host(spark):
    page = "<body><main><header>The site</header><h1>Title {0}</h1><article><header>By {0}</header><p>Text {0}</p></article></main></body>"
    rows = [(k, f"http://h/{k}", page.format(k), "t", "h", 1) for k in range(5)]
    got = page_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == {k: f"Title {k}\n\nBy {k}\n\nText {k}" for k in range(5)}


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("a < b <p>c", ["a < b", "c"]),
        ("x <a 'y", ["x <a 'y"]),
        ('<p title="a>b">c</p>', ["c"]),
        ("<p title='it\"s'>c</p> d", ["c", "d"]),
        ("<!-- never closed <p>x", []),
        ("<p>a<!DOCTYPE x>b", ["ab"]),
        ("a<script>if (a<b) '<p \"'</script >b<p>c", ["ab", "c"]),
        ("a<script>never closed <p>b", ["a"]),
        ("a<style></styleb", ["a"]),
        ("</p></div>x</p>", ["x"]),
        ("<p>&lt;b&gt; &amp;amp; &#x41;&nbsp;B</p>", ["<b> &amp; A B"]),
        ("", []),
    ],
)
def test_broken_markup(html, want):
    assert kept(html) == want


@pytest.mark.parametrize(
    "piece", ["<a '", "<a \"'>", "<a '\">", "<", "<!--", "<script", "</script", "<script></script", "<div>", "<div class=ad>", "<p>", "<b class=x>", "<div>&"]
)
def test_time_grows_with_the_page(piece):
    def took(n):
        begun = time.process_time()
        page_text.parse(piece * n + "<article>x</article>" + "<li></li></p></b>" * n)
        return time.process_time() - begun

    took(10)
    assert took(24_000) < 10 * took(6_000) + 0.2


def plain_importance(pages):
    """From pages of one host, by node and feature: entropies of what the pages show, summed one by one."""
    styles, texts, shown_on = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for at, page in enumerate({tuple(b[2] for b in p.blocks): p for p in reversed(pages)}.values()):
        for node, kind, feature, times in page.features:
            if kind == 0:
                styles[node][feature] += times
            else:
                texts[node, feature][at] += times
                shown_on[node, feature].add(at)
    entropy = lambda c: -sum(n / c.total() * math.log(n / c.total()) for n in c.values())
    out = {}
    for (node, feature), on in texts.items():
        if len(on) > 1:
            many = max(styles[node].total(), len(on), 2)
            content = 1 - entropy(on) / math.log(many)
            out[node, feature] = page_text.CONTENT_SHARE * content + (1 - page_text.CONTENT_SHARE) * entropy(styles[node]) / math.log(many)
    return out


def test_the_tree_of_a_host(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    common = [text(4) for _ in range(5)]
    rows, pages = [], []
    for k in range(40):
        parts = [f"<div class=c{j}><p>{c}</p></div>" for j, c in enumerate(common) if rng.random() < (0.2, 0.4, 0.6, 0.9, 1.0)[j]]
        parts += [f"<section><p>{text(3)}</p><p>{rng.choice(common)}</p></section>" for _ in range(rng.randrange(3))]
        rng.shuffle(parts)
        html = f"<body>{''.join(parts)}<div id=main-text><p>{text(20)}</p></div></body>"
        rows.append((k, "http://one.host/x", html, "t", "h", 1))
        pages.append(page_text.parse(html))
    rows += [(40, "http://one.host/y", rows[0][2], "t", "h", 1), (41, "http://two.host/", rows[1][2], "t", "h", 1)]
    want = plain_importance(pages)
    low = {key for key, value in want.items() if value < page_text.THRESHOLD}
    assert low and len(low) < len(want)
    got = {r.page_id: r.text for r in page_text.extract(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    for k, page in enumerate(pages):
        assert got[k] == "\n\n".join(t for node, zone, feature, t in page.blocks if zone == page_text.CONTENT or (node, feature) not in low)
    assert got[40] == got[0] and got[41] == "\n\n".join(b[3] for b in pages[1].blocks)
