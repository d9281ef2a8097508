"""Main text of web pages by a site style tree.

Every page is parsed into blocks of text under element nodes; a node is its chain of labels (tag, classes and id) from
the root. The pages of a host are merged by counting, for each node, in how many pages it occurs, which sequences of
children it shows there, and which block texts it holds. From these counts come two importances between 0 and 1:
presentation, the entropy of the child sequences over an element node's pages, and content, one minus the entropy of a
block's text over them. A text that every page repeats has entropy one and is unimportant; one that a single page has is
important. A content node, a text under an element node, has the mean of both, content weighing ``CONTENT_SHARE``.

What a page keeps follows from the node's zone. Named noise (navigation, footers, asides, forms, and classes or ids
that say so) weighs nothing and goes. A class says so by the word it ends with, but for words such as "area" or "box"
("site-footer", "ad-box"; not "has-sidebar", "related-work" or "elementor-widget-text"). Classes and ids never decide for
html, body, article and main, nor for wrappers: elements that hold the page's article or main, or over half of the text of
a page that has neither. Named content (article, main) is never below the threshold and stays, so that a passage that many
articles share is not lost. Anything else goes where its host's importance is below ``THRESHOLD``, a header within main but
outside any article too. A branch all of whose texts go is gone as a whole.

Pages that agree in all blocks count once per host, so that copies do not make their own text unimportant. Counts are
partial sums before every shuffle, and page texts are written once and only move if their host has branches to remove.

Defined cases. Null html or url count as empty; all pages without a host are one host. A page without main text has the
text "". Repeated rows and ids are kept, each row giving one result. Markup that is not closed ends where its parent
ends, or with the page. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import text_of
from ledgerleaf.session import materialise

THRESHOLD = 0.3
CONTENT_SHARE = 0.9

NOISE, OPEN, CONTENT = 0, 1, 2

# fixed values: names of HTML elements by what they are for
SKIPPED = frozenset("script style textarea title noscript template iframe object svg canvas math select option button input audio video map".split())
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE_TAGS = frozenset("head nav footer aside form menu dialog".split()) | SKIPPED
CONTENT_TAGS = frozenset("article main".split())
#: Elements that hold a whole page or article: their names say how it looks ("has-sidebar", "comments-open").
WHOLE_TAGS = frozenset("html body article main".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend li main menu nav ol p pre section summary table caption tbody thead tfoot tr ul".split()
)
SPACES = frozenset("br td th wbr img".split())
#: An opening tag closes the open element of the same group, up to the element that holds them.
CLOSES = {"p": ({"p"}, {"body", "div", "article", "section", "li", "td", "blockquote", "main"}), "li": ({"li"}, {"ul", "ol", "menu"}),
          "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Words in classes, ids and roles that name noise.
NOISE_WORDS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs footer sidebar ad ads advert adverts advertisement advertising banner sponsor sponsored "
    "promo promotion cookie cookies consent notice notices popup modal newsletter subscribe signup share sharing social related recommended "
    "comment comments replies disqus widget pagination pager toolbar masthead copyright login search complementary contentinfo".split()
)
HEADER_WORDS = frozenset(["header"])
#: Words before which a noise word tells of something that is elsewhere on the page, or not there.
ELSEWHERE = frozenset("has no not with without hide hidden show enable disable".split())
#: Words behind a noise word that only say how its element is laid out.
LAYOUT = frozenset(
    "area bar block body bottom box button buttons column container content entry form group head holder icon icons inner item items left line link links "
    "list message module outer overlay panel post posts right row section slot title top unit wrap wrapper zone".split()
) | NOISE_WORDS | HEADER_WORDS

_START = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*))")
_STOP = re.compile("[>\"']")
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_BARE_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Page(NamedTuple):
    #: (node, zone, feature, text) in page order; noise is left out.
    blocks: list[tuple[int, int, int, str]]
    #: (node, kind, feature, times): kind 0 has the child sequence of an element, kind 1 a block's text.
    features: list[tuple[int, int, int, int]]


class _Element:
    __slots__ = ("children", "content", "lost", "named", "node", "saved", "tag", "under", "weight", "zone")

    def __init__(self, tag: str, node: int, zone: int, saved: list[str] | None = None):
        self.tag, self.node, self.zone, self.children = tag, node, zone, []
        #: What stood before it in its block, for noise inside a line.
        self.saved = saved
        #: Whether it is noise by more than names; its number if it is so by name, and whether it or one around it is.
        self.lost, self.named, self.under = False, 0, False
        #: Characters of text in it that is not lost, and whether it holds an article or main.
        self.weight, self.content = 0, False


def _hash(*parts: object) -> int:
    value = xxhash.xxh64_intdigest("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _hidden(attributes: str) -> bool:
    """Whether attributes hide their element; the word in a class or another value does not."""
    if _HIDDEN.search(attributes):
        return True
    return bool("hidden" in attributes.lower() and _BARE_HIDDEN.search(_QUOTED.sub('""', attributes)))


def noise_words(names: str) -> set[str]:
    """The words by which classes, ids and roles call their element noise."""
    found = set()
    for name in names.split():
        words = _WORDS.findall(name)
        for k, word in enumerate(words):
            # builders call every element a widget of theirs; only what begins so is one of a sidebar
            if word in NOISE_WORDS or word in HEADER_WORDS:
                if (word != "widget" or k == 0) and (k == 0 or words[k - 1] not in ELSEWHERE) and all(w in LAYOUT for w in words[k + 1 :]):
                    found.add(word)
    return found


def _zone(tag: str, words: set[str], hidden: bool, above: int, article: bool) -> int:
    """``article``: whether the nearest content element around it is an article, whose header is its own."""
    if above == NOISE or hidden or tag in NOISE_TAGS or words & NOISE_WORDS:
        return NOISE
    if above == CONTENT:
        return OPEN if tag == "header" and not article else CONTENT
    if tag in CONTENT_TAGS:
        return CONTENT
    return NOISE if (tag == "header" and not article) or words & HEADER_WORDS else OPEN


def _markup(html: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, tag, attributes) of each piece of markup; comments and declarations have no tag, and elements of
    raw text are one piece.

    A quote that is never closed is taken as any other character. Each character is looked at a bounded number of times:
    whatever is not found once is not there later either.
    """
    position, size = 0, len(html)
    closed = {'"': True, "'": True}
    while found := _START.search(html, position):
        start = found.start()
        if found[1]:
            end = html.find("-->", found.end())
            position = size if end < 0 else end + 3
            yield start, position, "", "", ""
            continue
        at = found.end()
        while stop := _STOP.search(html, at):
            quote, at = stop[0], stop.end()
            if quote == ">":
                break
            if found[4] and closed[quote]:
                end = html.find(quote, at)
                closed[quote] = end >= 0
                at = end + 1 if end >= 0 else at
        if not stop:
            return  # no end of markup from here on: the rest is text
        position, slash, tag = at, found[3] or "", (found[4] or "").lower()
        if tag in RAW and not slash:
            closing = re.compile(f"</{tag}", re.I).search(html, at)
            position = (html.find(">", closing.end()) if closing else -1) + 1 or size
        yield start, position, slash, tag, html[found.end() : at - 1]


def parse(html: str) -> Page:
    """Blocks and style-tree features of one page; a page with named wrappers is read once more, without their names."""
    page, wrappers = _parse(html, frozenset())
    return _parse(html, wrappers)[0] if wrappers else page


def _parse(html: str, wrappers: frozenset[int]) -> tuple[Page, frozenset[int]]:
    """A page whose elements ``wrappers``, by number, count as not named; and which elements are named but are wrappers.

    Those hold the page's article or main; on a page without either, more than half of its text outside noise elements.
    """
    root, number, named, wrapping = _Element("", 0, OPEN), 0, {}, set()
    stack, blocks, held, content = [root], [], [], False
    opened: Counter[str] = Counter()
    shown: Counter[tuple[int, int, int]] = Counter()

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            at = stack[-1]
            if not at.lost:
                at.weight += len(text)
            feature = _hash(text)
            shown[at.node, 1, feature] += 1
            if at.zone != NOISE:
                blocks.append((at.node, at.zone, feature, text))

    def close(depth: int) -> None:
        """Ends the elements from a depth on, innermost first."""
        while len(stack) > depth:
            element = stack[-1]
            flush()
            if element.saved is not None:
                held.extend(element.saved)
            shown[element.node, 0, _hash(*element.children)] += 1
            if element.named:
                named[element.named] = element.weight
            opened[element.tag] -= 1
            stack.pop()
            stack[-1].weight += element.weight

    position = 0
    for start, end, slash, tag, attributes in _markup(html):
        if start > position:
            held.append(entities.unescape(html[position:start]))
        position = end
        if not tag:
            continue
        if slash:
            if tag in SPACES:
                held.append(" ")
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in SPACES:
            held.append(" ")
        if tag in BLOCKS:
            flush()
        if tag in CLOSES:
            ends, holders = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1) if any(opened[e] for e in ends) else ():
                if stack[i].tag in ends:
                    close(i)
                    break
                if stack[i].tag in holders:
                    break
        if tag in RAW or tag in VOID:
            continue
        # inline markup has no node of its own: its text belongs to the block it stands in
        if tag not in BLOCKS and tag not in NOISE_TAGS and not _NAMES.search(attributes) and not _hidden(attributes):
            continue
        names = " ".join(m[2].strip("\"'") for m in _NAMES.finditer(attributes)).lower()
        label = f"{tag} {names}".strip()
        above = stack[-1]
        words, hidden = noise_words(names), _hidden(attributes)
        number += 1
        if tag in WHOLE_TAGS or number in wrappers:
            words = set()
        zone = _zone(tag, words, hidden, above.zone, opened["article"] > 0)
        lost = above.lost or hidden or tag in NOISE_TAGS or tag == "header" and not above.under and zone == NOISE
        if tag in CONTENT_TAGS and not lost:
            content = True
            for around in reversed(stack):
                if around.content:
                    break
                around.content = True
                if around.named:
                    wrapping.add(around.named)
        saved = None
        if tag not in BLOCKS:
            if zone == above.zone:
                continue
            if zone == NOISE:
                saved = held.copy()
                held.clear()
            else:
                flush()
        if not above.children or above.children[-1] != label:
            above.children.append(label)
        stack.append(_Element(tag, _hash(above.node, label), zone, saved=saved))
        stack[-1].lost, stack[-1].named, stack[-1].under = lost, number if words else 0, above.under or bool(words)
        opened[tag] += 1
    if position < len(html):
        held.append(entities.unescape(html[position:]))
    flush()
    close(1)
    if not content:
        wrapping = {mark for mark, held in named.items() if 2 * held > root.weight}
    return Page(blocks, [(*key, times) for key, times in shown.items()]), frozenset(wrapping)


_BLOCK = pa.list_(pa.struct([("node", pa.int64()), ("zone", pa.int32()), ("feature", pa.int64()), ("text", pa.string())]))
_FEATURE = pa.list_(pa.struct([("node", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64()), ("times", pa.int64())]))
_PARSED = (
    "page_id long, url string, host string, content long, "
    "blocks array<struct<node: long, zone: int, feature: long, text: string>>, features array<struct<node: long, kind: int, feature: long, times: long>>"
)


def _parse_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            pages = [parse(h or "") for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("page_id", "url", "host")),
                    pa.array([_hash(*(b[2] for b in p.blocks)) for p in pages], pa.int64()),
                    pa.array([[{"node": n, "zone": z, "feature": f, "text": t} for n, z, f, t in p.blocks] for p in pages], _BLOCK),
                    pa.array([[{"node": n, "kind": k, "feature": f, "times": c} for n, k, f, c in p.features] for p in pages], _FEATURE),
                ],
                names=["page_id", "url", "host", "content", "blocks", "features"],
            )


def importance(parsed: DataFrame) -> DataFrame:
    """(host, node, feature, importance) of the content nodes that more than one page of a host shows."""
    once = parsed.groupBy("host", "content").agg(F.min("row_no").alias("row_no")).select("row_no")
    features = parsed.join(once, "row_no", "left_semi").select("host", F.explode("features").alias("f")).select("host", "f.*")
    log = lambda column: F.log(column.cast("double"))
    merged = materialise(
        features.groupBy("host", "node", "kind", "feature").agg(
            F.sum("times").alias("times"), F.sum(F.col("times") * log(F.col("times"))).alias("own"), F.count(F.lit(1)).alias("pages")
        ),
        "style-tree",
    )
    nodes = merged.filter("kind = 0").groupBy("host", "node").agg(
        F.sum("times").alias("shown"), F.sum(F.col("times") * log(F.col("times"))).alias("styles")
    )
    texts = merged.filter("kind = 1 and pages > 1").select("host", "node", "feature", "times", "own", "pages")
    both = texts.join(nodes, ["host", "node"])
    many = F.greatest("shown", "pages", F.lit(2))
    content = 1 - (log(F.col("times")) - F.col("own") / F.col("times")) / log(many)
    styles = (log(F.col("shown")) - F.col("styles") / F.col("shown")) / log(many)
    return both.select("host", "node", "feature", (CONTENT_SHARE * content + (1 - CONTENT_SHARE) * styles).alias("importance"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    url = F.col(url_col).cast("string")
    host = F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host.alias("host"), text_of(F.col(html_col)).alias("html"))
    parsed = materialise(rows.mapInArrow(_parse_all, _PARSED).withColumn("row_no", F.monotonically_increasing_id()), "pages")
    low = materialise(importance(parsed).filter(F.col("importance") < THRESHOLD).select("host", "node", "feature"), "low-branches")
    undecided = F.array_distinct(F.transform(F.filter("blocks", lambda b: b.zone == OPEN), lambda b: F.struct(b.node.alias("node"), b.feature.alias("feature"))))
    asked = parsed.select("row_no", "host", F.explode(undecided).alias("b")).select("row_no", "host", "b.node", "b.feature")
    gone = asked.join(low, ["host", "node", "feature"]).groupBy("row_no").agg(F.collect_set(F.struct("node", "feature")).alias("gone"))  # of one page
    listed = lambda b: F.array_contains(F.col("gone"), F.struct(b.node.alias("node"), b.feature.alias("feature")))
    kept = F.filter("blocks", lambda b: (b.zone == CONTENT) | ~F.coalesce(listed(b), F.lit(False)))
    text = F.array_join(F.transform(kept, lambda b: b.text), "\n\n")
    out = parsed.join(materialise(gone, "gone"), "row_no", "left").select("page_id", "url", text.alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
