"""Class words on elements that hold the main content."""

import pytest

from ledgerleaf.llm import page_text

TEXT = "<p>A long passage of main text that the page is about.</p>"


def kept(html):
    return [b[3] for b in page_text.parse(html).blocks]


@pytest.mark.parametrize(
    "page",
    [
        f'<html class="no-login"><body class="has-sidebar">{TEXT}</body></html>',
        f'<body><div id="page" class="with-nav">{TEXT}<nav>menu</nav></div></body>',
        f'<body><div class="with-sidebar"><div class="no-ads"><article class="post comments-open">{TEXT}</article></div><div class="ad">buy</div></div></body>',
        f'<body><article><div class="md hidden lg">{TEXT}</div></article></body>',
        f'<body><nav>menu</nav><main class="no-sidebar">{TEXT}<div class="share">like it</div></main></body>',
    ],
)
def test_wrappers_keep_their_text_and_lose_the_noise(page):
    assert kept(page) == ["A long passage of main text that the page is about."]


def test_named_noise_still_goes():
    assert kept(f'<body>{TEXT}<div class="comments">first</div><div hidden>x</div><div style="display:none">y</div></body>') == kept(TEXT)
    assert kept(f'<article>{TEXT}</article><div class="comments">{TEXT * 9}</div>') == kept(TEXT)
    assert kept("<nav>only</nav>") == []


def test_a_wrapper_named_main_is_judged_by_its_host(spark):
    page = '<body><div id="main-wrapper"><header>Site</header><div>Told on every page</div><p>Only page {}</p></div></body>'
    rows = [(k, f"http://h/{k}", page.format(k)) for k in range(5)]
    got = page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in got) == [f"Only page {k}" for k in range(5)]
