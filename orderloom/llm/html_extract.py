"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut at block-level tags into flat text blocks. A block has its word count and
link density, those of its two neighbours, and marks for the containers around it. A
decision tree says which blocks are content. It is trained when the plan is built, on
the blocks of ``EXAMPLES``: a small table of page fragments, each marked content or
boilerplate. Kept blocks join in page order.

A page is read forward once: a tag ends where its attributes end, quotes count only
where a value begins, and what is open is counted as it opens and closes. The time grows
in proportion to the page, whatever its markup. Pages are handled one by one inside
tasks, without a shuffle.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEPTH = 9
PAGES_PER_BATCH = 512

# HTML's element kinds.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
SKIPPED_TAGS = frozenset("script style noscript template title iframe object svg math textarea button canvas head".split())
RAW_TAGS = frozenset("script style title textarea iframe noscript".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT_TAGS = frozenset(("article", "main"))
SIDE_TAGS = frozenset("nav footer aside form menu select option dialog fieldset".split())
#: Words of class, id and role names that mark what is not the article.
SIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice pagination popup promo promoted promotion related replies reply respond share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription toolbar widget alert dialog complementary contentinfo "
    "discussion toc tracking search".split()
)
#: Of these, what names a headline where it stands inside the article.
HEADER_NAMES = frozenset(("header",))
CONTENT_NAMES = frozenset("article content post story entry main body text".split())
#: Openings that end an unclosed paragraph.
ENDS_PARAGRAPH = BLOCK_TAGS - {"body", "head", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option"}

_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_BETWEEN = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"(=?[^\s/>=]*)\s*(=?)\s*")
_UNQUOTED = re.compile(r"[^\s>]*")
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I | re.A) for tag in RAW_TAGS}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_NAME_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    heading: bool
    in_article: bool
    in_content: bool
    side_tags: int
    side_names: int
    in_list: bool
    mark: str = ""

    @property
    def link_density(self) -> float:
        return self.link_words / self.words if self.words else 0.0


@dataclass
class _Open:
    tag: str
    block: bool
    heading: bool
    article: bool
    content: bool
    side_tag: bool
    side_name: bool
    skipped: bool
    mark: str = ""


def _opened(tag: str, values: dict[str, str], in_article: bool) -> _Open:
    names = {w for name in ("class", "id", "role") for w in _NAME_WORD.findall(values.get(name, "").lower())}
    hidden = (
        "hidden" in values
        or values.get("aria-hidden", "").strip().lower() == "true"
        or bool(_NO_DISPLAY.search(values.get("style", "")))
    )
    # A header inside the article is its own headline; elsewhere it is the site's.
    side_tag = tag in SIDE_TAGS or tag == "header" and not in_article
    side_name = bool(names & (SIDE_NAMES - HEADER_NAMES if in_article else SIDE_NAMES)) and tag not in ("body", "html")
    return _Open(
        tag,
        tag in BLOCK_TAGS,
        tag in HEADINGS,
        tag in CONTENT_TAGS or "main" in values.get("role", "").lower().split(),
        bool(names & CONTENT_NAMES) and not side_name and tag in ("div", "section", "td"),
        side_tag,
        side_name,
        tag in SKIPPED_TAGS or hidden,
        values.get("data-y", ""),
    )


class _Stack:
    """Open elements, with counts of their kinds."""

    KINDS = ("heading", "article", "content", "side_tag", "side_name", "skipped")

    def __init__(self) -> None:
        self.open: list[_Open] = []
        #: Depths of the open blocks, and the inline elements open since the last of them.
        self.blocks: list[int] = []
        self.inline: list[Counter] = [Counter()]
        self.tags: Counter = Counter()
        self.marks: list[str] = []
        self.kinds = dict.fromkeys(self.KINDS, 0)

    def push(self, element: _Open) -> None:
        if element.block:
            self.blocks.append(len(self.open))
            self.inline.append(Counter())
        else:
            self.inline[-1][element.tag] += 1
        self.open.append(element)
        self.tags[element.tag] += 1
        if element.mark:
            self.marks.append(element.mark)
        for kind in self.KINDS:
            self.kinds[kind] += getattr(element, kind)

    def pop(self) -> None:
        element = self.open.pop()
        if element.block:
            self.blocks.pop()
            self.inline.pop()
        else:
            self.inline[-1][element.tag] -= 1
        self.tags[element.tag] -= 1
        if element.mark:
            self.marks.pop()
        for kind in self.KINDS:
            self.kinds[kind] -= getattr(element, kind)

    def close(self, tag: str) -> None:
        """End the innermost ``tag`` and all in it. An inline element's end doesn't close
        the blocks that it is left open in."""
        there = self.tags[tag] if tag in BLOCK_TAGS else self.inline[-1][tag]
        while there:
            there = self.open[-1].tag != tag
            self.pop()

    def end_paragraph(self) -> None:
        """End the innermost block if it is a paragraph, which a block's beginning does."""
        if self.blocks and self.open[self.blocks[-1]].tag == "p":
            depth = self.blocks[-1]
            while len(self.open) > depth:
                self.pop()


class _Scanner:
    """Reads the tags of a page, forward only."""

    def __init__(self, page: str):
        self.page = page
        self._gone: set[str] = set()

    def find(self, wanted: str, at: int) -> int:
        """Where ``wanted`` comes next; not looked for again once there is no more of it."""
        if wanted in self._gone:
            return -1
        found = self.page.find(wanted, at)
        if found < 0:
            self._gone.add(wanted)
        return found

    def past(self, wanted: str, at: int) -> int:
        """The place behind ``wanted``, or the page's end."""
        found = self.find(wanted, at)
        return len(self.page) if found < 0 else found + len(wanted)

    def markup(self, at: int) -> int:
        """The place behind a comment, declaration or nameless end at ``at``; ``at`` if there is none."""
        page = self.page
        if page.startswith("<!--", at):
            return self.past("-->", at + 4)
        if page.startswith("<![CDATA[", at) and self.find("]]>", at) >= 0:
            return self.past("]]>", at)
        return self.past(">", at) if page.startswith(("<!", "<?", "</"), at) else at

    def attributes(self, at: int) -> tuple[dict[str, str], int, bool]:
        """(values by name, the place behind the tag, whether it closes itself).

        Of a repeated name the first value counts. A value whose quote never closes ends
        with the tag at the next ``>``; a tag that nothing ends takes the rest of the page.
        """
        page, values, begin = self.page, {}, at
        while True:
            gap = _BETWEEN.match(page, at)
            at = gap.end()
            if at >= len(page):
                return values, len(page), False
            if page[at] == ">":
                return values, at + 1, gap[0].endswith("/")
            found = _ATTRIBUTE.match(page, at)
            name, at = found[1], found.end()
            value = ""
            if found[2]:
                quote = page[at : at + 1]
                if quote in ('"', "'"):
                    end = self.find(quote, at + 1)
                    if end < 0:
                        return values, self.past(">", begin), False
                    value, at = page[at + 1 : end], end + 1
                else:
                    plain = _UNQUOTED.match(page, at)
                    value, at = plain[0], plain.end()
            values.setdefault(name.lower(), value)


def blocks(page: str) -> list[Block]:
    """Flat text blocks of a page, in order, without those that hold no text."""
    found: list[Block] = []
    stack, scanner = _Stack(), _Scanner(page)
    parts: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            kinds = stack.kinds
            found.append(
                Block(
                    text,
                    len(text.split()),
                    len(" ".join(linked).split()),
                    kinds["heading"] > 0,
                    kinds["article"] > 0,
                    kinds["content"] > 0,
                    kinds["side_tag"],
                    kinds["side_name"],
                    stack.tags["li"] > 0,
                    stack.marks[-1] if stack.marks else "",
                )
            )
        parts.clear()
        linked.clear()

    def say(raw: str) -> None:
        if raw and not stack.kinds["skipped"]:
            text = html.unescape(raw)
            parts.append(text)
            if stack.tags["a"]:
                linked.append(text)

    said, at = 0, page.find("<")
    while at >= 0:
        closes = page.startswith("/", at + 1)
        name = _TAG_NAME.match(page, at + 1 + closes)
        behind = at if name else scanner.markup(at)
        if name is None and behind == at:
            at = page.find("<", at + 1)  # a plain sign
            continue
        say(page[said:at])
        if name:
            tag = name[0].lower()
            values, behind, empty = scanner.attributes(name.end())
            if tag in BLOCK_TAGS:
                flush()
            elif tag == "br":
                parts.append(" ")
            if closes:
                stack.close(tag)
            elif tag in RAW_TAGS:
                end = _RAW_ENDS[tag].search(page, behind)
                behind = scanner.past(">", end.start()) if end else len(page)
            elif tag not in VOID_TAGS and not empty:
                if tag in ENDS_PARAGRAPH:
                    stack.end_paragraph()
                if tag in ("li", "option", "dt", "dd", "tr", "td", "th") and stack.open and stack.open[-1].tag == tag:
                    stack.pop()
                stack.push(_opened(tag, values, stack.kinds["article"] > 0))
        said, at = behind, page.find("<", behind)
    say(page[said:])
    flush()
    return found


def block_features(found: list[Block]) -> np.ndarray:
    """A row per block: its own and its neighbours' word count and link density, and its marks."""
    words = np.array([0, *(b.words for b in found), 0], dtype=np.float64)
    density = np.array([0, *(b.link_density for b in found), 0], dtype=np.float64)
    has_article = any(b.in_article for b in found)
    own = np.array(
        [
            (b.heading, b.in_article, b.in_content, b.side_tags > 0, b.side_names > 0, b.in_list, has_article)
            for b in found
        ],
        dtype=np.float64,
    ).reshape(-1, 7)
    near = [a[i : i + len(found)] for a in (words, density) for i in (1, 0, 2)]
    return np.column_stack([*near, own])


# A small labelled table: page fragments with blocks of the article (data-y="1") and others (data-y="0").
LONG = "some longer running text that says a thing or two about the matter at hand and goes on for a while " * 3
SHORT = "A short line."
SIDE_FRAGMENTS = (
    '<nav data-y="0"><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li><li>Plain</li></ul></nav>',
    f'<header data-y="0"><h1><a href="/">The site</a></h1><p>{SHORT}</p><p>{LONG}</p></header>',
    f'<div class="ad" data-y="0">{SHORT}</div>',
    f'<div class="ad" data-y="0"><p>{LONG}</p></div>',
    f'<aside data-y="0"><h2>Related</h2><p>{LONG}</p><ul><li><a href="/c">More of it</a></li><li>{SHORT}</li></ul></aside>',
    f'<div class="cookie-notice" data-y="0"><p>{SHORT}</p><p>{LONG}</p></div>',
    f'<form data-y="0"><p>{SHORT}</p><label>Your name</label></form>',
    f'<section class="comments" data-y="0"><h2>Comments</h2><p>{LONG}</p><p>{SHORT}</p></section>',
    f'<footer data-y="0"><p>{SHORT}</p><p>{LONG}</p><a href="/d">Terms</a></footer>',
    '<div data-y="0"><a href="/e">One</a> <a href="/f">Two</a> <a href="/g">Three</a></div>',
    '<ul data-y="0"><li><a href="/h">Next page</a></li><li><a href="/i">Previous page</a></li></ul>',
)
TEXT_FRAGMENTS = (
    f'<h1 data-y="1">A headline</h1><p data-y="1">{LONG}</p><p data-y="1">{SHORT}</p><p data-y="1">{LONG}</p>',
    f'<h1 data-y="1">A headline</h1><p data-y="1">{SHORT}</p><h2 data-y="1">Part</h2><p data-y="1">Word.</p>',
    f'<p data-y="1">{LONG} <a href="/j">with a link</a></p><ul><li data-y="1">{SHORT}</li><li data-y="1">{LONG}</li></ul>',
    f'<p data-y="1"><a href="/k">Linked words</a></p><blockquote data-y="1">{LONG}</blockquote><pre data-y="1">x = 1</pre>',
    f'<header class="entry-header" data-y="1"><h1>A headline</h1><p>{SHORT}</p></header><p data-y="1">{LONG}</p><h2 class="section-header" data-y="1">Part</h2><p data-y="1">{LONG}</p>',
)
#: Beside an article element, text without any mark isn't the article's.
UNMARKED_FRAGMENTS = (
    f'<div data-y="0"><p>{SHORT}</p><p>{LONG}</p></div>',
    f'<p data-y="0">{LONG}</p>',
    f'<div data-y="0"><h2>More</h2>{SHORT}</div>',
    f'<div class="text" data-y="0"><p>{SHORT}</p></div>',
)
#: Without an article element, only running text and its headings are told from the rest.
LOOSE_FRAGMENTS = (
    f'<div><h2 data-y="1">Part</h2><p data-y="1">{LONG}</p><p data-y="1">{LONG}</p><p data-y="1">{SHORT}</p><p data-y="1">{LONG}</p></div>',
    f'<div><p data-y="1">{LONG}</p><p data-y="1">{SHORT}</p></div>',
    f'<div><p data-y="1">{LONG}</p><ul><li data-y="1">{SHORT}</li><li data-y="1">{LONG}</li></ul></div>',
    f'<div class="content"><p data-y="1">{LONG}</p><p data-y="1"><a href="/l">Linked words</a></p></div>',
)


def examples() -> list[str]:
    """Pages that put each side fragment before, after and inside the text."""
    pages = []
    for side in SIDE_FRAGMENTS:
        for text in TEXT_FRAGMENTS:
            article = f"<article>{text}</article>"
            pages += [f"<body>{side}{article}</body>", f"<body>{article}{side}</body>"]
            if "class=" in side or side.startswith(("<nav", "<aside", "<form", "<footer")):
                pages.append(f"<body><article>{text}{side}{text}</article></body>")
    for text in TEXT_FRAGMENTS:
        for side in UNMARKED_FRAGMENTS:
            pages += [f"<body>{side}<article>{text}</article></body>", f"<body><main>{text}</main>{side}</body>"]
    for side in SIDE_FRAGMENTS:
        for text in LOOSE_FRAGMENTS:
            pages += [f"<body>{side}{text}</body>", f"<body>{text}{side}</body>"]
    return pages


@dataclass
class Tree:
    feature: int = -1
    threshold: float = 0.0
    low: Tree | None = None
    high: Tree | None = None
    content: bool = False

    def judge(self, x: np.ndarray) -> np.ndarray:
        if self.low is None or self.high is None:
            return np.full(len(x), self.content)
        return np.where(x[:, self.feature] <= self.threshold, self.low.judge(x), self.high.judge(x))


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH) -> Tree:
    """A decision tree by Gini impurity."""
    tree = Tree(content=bool(y.mean() >= 0.5)) if len(y) else Tree()
    if depth == 0 or len(np.unique(y)) < 2:
        return tree
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            impurity = sum(side.size * side.mean() * (1 - side.mean()) for side in (y[low], y[~low]))
            if best is None or impurity < best[0] - 1e-9:
                best = (impurity, f, cut)
    if best is None or best[0] >= y.size * y.mean() * (1 - y.mean()) - 1e-9:
        return tree
    low = x[:, best[1]] <= best[2]
    tree.feature, tree.threshold = best[1], best[2]
    tree.low, tree.high = grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)
    return tree


def train() -> Tree:
    x, y = [], []
    for page in examples():
        found = blocks(page)
        x.append(block_features(found))
        y += [b.mark == "1" for b in found]
    return grow(np.vstack(x), np.array(y, dtype=np.float64))


def main_text(page: str, tree: Tree) -> str:
    """The content blocks of a page, joined by newlines; empty if there are none."""
    found = blocks(page)
    if not found:
        return ""
    kept = tree.judge(block_features(found))
    return "\n".join(b.text for b, keep in zip(found, kept, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and ``text`` of each row of ``pages``.

    A null page is an empty one and has an empty text. Null ids and urls and repeated
    rows pass through; an empty table gives no rows. Other columns are not used.
    """
    tree = train()
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, PAGES_PER_BATCH):
                batch = whole.slice(lo, PAGES_PER_BATCH)
                texts = pa.array([main_text(page.as_py(), tree) for page in batch.column(2)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], schema=schema)

    source = pages.select(F.col("page_id").cast("bigint"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return source.mapInArrow(run, "page_id bigint, url string, text string")
