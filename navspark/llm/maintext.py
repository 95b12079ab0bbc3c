"""Main text of web pages by two passes of block rules.

A page is cut at block tags into blocks of text. Blocks in menus, footers,
forms, adverts, notices or comments, by tag, role or class name, go at once.
The first pass classifies the others from their own length, link density and
stop-word density; the second gives ambiguous blocks the label of the nearest
decided neighbours. Where a page marks its article (``article``, ``main`` or a
usual class name), blocks outside it go and it vouches for blocks inside it
that nothing speaks against, so that text in languages without known stop words
is kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navspark.llm.shipping import ship

#: A block shorter than this (code points) is short, one longer than ``LONG`` decides alone.
SHORT, LONG = 70, 200
#: A higher share of code points in links is a menu.
MAX_LINK_DENSITY = 0.33
#: A share of stop words that speaks for prose, and one that leaves it open.
MANY_STOP_WORDS, SOME_STOP_WORDS = 0.30, 0.12
#: Below this share in all unlinked text of a page its language is taken for unknown.
UNKNOWN_LANGUAGE = 0.04

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    """
    a about after all also an and are as at be been but by can for from had has have he her his i if in into is it its
    more no not of on or our she so some than that the their them there they this to up was we were what when which who
    will with would you your
    als am auch auf aus bei das dass dem den der des die durch ein eine einen einer er es für hat ich im in ist mit nach
    nicht noch nur oder sich sie sind über um und von vor war werden wie wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour
    qu que qui sa se ses son sont sur un une vous
    al como con de del el ella en entre era es esta este fue ha la las lo los más me muy no o para pero por que se sin
    sobre su sus también un una y ya
    """.split()
)

# HTML elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
CONTAINERS = frozenset(
    "article aside blockquote body div dl fieldset figure footer form header html main menu nav ol section table tbody "
    "td tfoot th thead tr ul dialog details".split()
)
DROPPED = frozenset(
    "nav footer aside form head script style noscript template select button textarea iframe svg math canvas object "
    "audio video menu dialog title datalist map applet xmp noembed".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login paywall "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer masthead topbar "
    "share sharing social related recommended recommendations trending comment comments commentlist disqus reply replies "
    "respond pager pagination toc notice notices notification alert disclaimer copyright skip toolbar outbrain taboola".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())
ARTICLE_NAMES = frozenset(
    "article-body article-content article-text article__body article__content articlebody entry-content post-content "
    "post-body post__content story-body story-content".split()
)
MAIN_NAMES = frozenset("main maincontent main-content content page-content primary".split())

_TAG = re.compile(
    r"""<(?:
        !--(?P<comment>.*?)(?:--!?>|\Z)
      | (?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))
      | [!?/][^>]*+(?:>|\Z)
    )""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_WORD_EDGES = ".,;:!?()[]\"'«»„“”‚‘’…"
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_GOOD, _BAD, _OPEN, _NEAR = 1, 0, 2, 3


@dataclass(slots=True)
class Block:
    text: str
    tag: str
    linked: int  # code points inside links
    scope: int  # 2 in an article, 1 in the main part, 0 elsewhere
    parent: int  # number of the innermost container


@dataclass(slots=True)
class _Open:
    name: str
    dropped: bool
    scope: int
    link: bool
    parent: int


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    tag: str = ""
    scope: int = 0
    parent: int = 0
    containers: int = 0

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                linked = sum(len(" ".join(x.split())) for x in self.linked)
                self.blocks.append(Block(text, self.tag, linked, self.scope, self.parent))
            self.pieces, self.linked = [], []


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _names(attributes: dict[str, str]) -> list[str]:
    return f"{attributes.get('class', '')} {attributes.get('id', '')}".split()


def _parts(name: str) -> list[str]:
    return [p.lower() for p in _NAME_PART.findall(name)]


def _is_dropped(tag: str, attributes: dict[str, str], scope: int) -> bool:
    """Whether an element is no part of the main text by its tag, role or names."""
    if tag in DROPPED or (tag == "header" and not scope):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in DROPPED_ROLES or "hidden" in attributes or attributes.get("aria-modal") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return True
    keeps = tag in ("article", "main", "body", "html")
    for name in _names(attributes):
        parts = _parts(name)
        if not parts or parts[0] in ("has", "with", "no", "is", "without"):
            continue
        if keeps:
            if not COMMENT_NAMES.isdisjoint(parts) and tag == "article":
                return True
        elif not DROPPED_NAMES.isdisjoint(parts) or (parts[-1] == "header" and not scope and parts[0] in ("header", "page", "site")):
            return True
    return False


def _scope(tag: str, attributes: dict[str, str]) -> int:
    if tag == "article" or attributes.get("itemprop", "").lower() == "articlebody" or attributes.get("role") == "article":
        return 2
    names = {n.lower() for n in _names(attributes)} if attributes else set()
    if names & ARTICLE_NAMES:
        return 2
    return 1 if tag == "main" or attributes.get("role") == "main" or names & MAIN_NAMES else 0


def blocks_of(source: str) -> list[Block]:
    """The page's blocks in order, those of dropped elements left out."""
    page = _Page()
    stack: list[_Open] = []
    at = 0

    def text(piece: str) -> None:
        top = stack[-1] if stack else None
        if not piece or (top and top.dropped):
            return
        if "&" in piece:
            piece = html.unescape(piece)
        if not page.pieces:
            page.scope, page.parent = (top.scope, top.parent) if top else (0, 0)
            page.tag = next((o.name for o in reversed(stack) if o.name not in INLINE), "")
        page.pieces.append(piece)
        if top and top.link:
            page.linked.append(piece)

    def floor() -> int:
        """The number of open elements up to and with the innermost container."""
        i = len(stack)
        while i and stack[i - 1].name not in CONTAINERS:
            i -= 1
        return i

    def close_above(names: tuple[str, ...], base: int) -> None:
        for i in range(base, len(stack)):
            if stack[i].name in names:
                del stack[i:]
                return

    while m := _TAG.search(source, at):
        text(source[at : m.start()])
        at = m.end()
        if m["name"] is None:
            continue
        tag, inline = m["name"].lower(), m["name"].lower() in INLINE
        if not inline and tag != "wbr":
            if tag == "br":
                text(" ")
                continue
            if tag == "img":
                continue
            page.flush()
        if m["close"]:
            if tag in ("html", "body"):
                continue
            base = 0 if tag in CONTAINERS else floor()
            if tag in ("li", "dt", "dd", "option") or not (inline or tag in CONTAINERS):
                base = min(base, floor())
            for i in range(len(stack) - 1, base - 1, -1):
                if stack[i].name == tag:
                    del stack[i:]
                    break
            continue
        if tag in VOID:
            continue
        if not inline:
            close_above(("p", *_HEADINGS) if tag in CONTAINERS or tag == "p" else ("p",), floor())
            if tag == "li":
                close_above(("li",), floor())
            elif tag in ("dt", "dd"):
                close_above(("dt", "dd"), floor())
            elif tag in ("td", "th", "tr"):
                _close_cells(stack, tag)
        if tag == "a":
            # A link inside a link ends the first.
            close_above(("a",), floor())
        if tag in ("article", "main"):
            # Menus and page headers hold no articles: one that is still open was never closed.
            for i, o in enumerate(stack):
                if o.dropped:
                    if o.name in ("nav", "header", "head", "title"):
                        del stack[i:]
                    break
        elif tag == "body":
            del stack[:]
        attributes = _attributes(m["attributes"]) if len(m["attributes"]) > 1 else {}
        top = stack[-1] if stack else None
        inherited = top.scope if top else 0
        dropped = bool(top and top.dropped) or _is_dropped(tag, attributes, inherited)
        page.containers += tag in CONTAINERS
        parent = page.containers if tag in CONTAINERS else top.parent if top else 0
        scope = max(inherited, _scope(tag, attributes))
        stack.append(_Open(tag, dropped, scope, tag == "a" or bool(top and top.link), parent))
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
            at = end.start() if end else len(source)
    text(source[at:])
    page.flush()
    return page.blocks


def _close_cells(stack: list[_Open], tag: str) -> None:
    for i in range(len(stack) - 1, -1, -1):
        name = stack[i].name
        if name == "table":
            return
        if name in ("td", "th") or (name == "tr" and tag == "tr"):
            del stack[i:]


def _stop_words(text: str) -> tuple[int, int]:
    words = [w.strip(_WORD_EDGES) for w in text.lower().split()]
    return sum(map(STOP_WORDS.__contains__, words)), len(words)


def classify(blocks: list[Block]) -> list[bool]:
    """Which blocks are main text."""
    scope = max((b.scope for b in blocks if not _is_menu(b)), default=0)
    inside = [b.scope == scope for b in blocks] if scope else [True] * len(blocks)
    found = [_stop_words(b.text) for b in blocks]
    known = sum(s for (s, _), b in zip(found, blocks, strict=True) if not b.linked) >= UNKNOWN_LANGUAGE * sum(
        n for (_, n), b in zip(found, blocks, strict=True) if not b.linked
    )
    places = [i for i, ok in enumerate(inside) if ok]
    labels = [_first_pass(blocks[i], found[i], bool(scope), known) for i in places]
    final = _second_pass(labels, [blocks[i] for i in places], bool(scope))
    out = [False] * len(blocks)
    for i, good in zip(places, final, strict=True):
        out[i] = good
    return out


def _is_menu(b: Block) -> bool:
    return b.linked > MAX_LINK_DENSITY * len(b.text)


def _first_pass(b: Block, found: tuple[int, int], vouched: bool, known: bool) -> int:
    density = found[0] / max(found[1], 1)
    if _is_menu(b):
        # A linked line of an article may be its source or author; elsewhere, and in lists, it is a menu.
        return _OPEN if vouched and (b.tag in ("p", "blockquote", "figcaption") or b.tag in _HEADINGS) else _BAD
    if vouched:
        return _GOOD if len(b.text) >= SHORT or b.tag == "h1" else _OPEN
    if "©" in b.text:
        return _BAD
    if len(b.text) < SHORT:
        return _BAD if b.linked else _OPEN
    if not known:
        return _GOOD if len(b.text) > LONG else _NEAR
    if density >= MANY_STOP_WORDS:
        return _GOOD if len(b.text) > LONG else _NEAR
    return _NEAR if density >= SOME_STOP_WORDS else _BAD


def _second_pass(labels: list[int], blocks: list[Block], vouched: bool) -> list[bool]:
    """Ambiguous blocks take the label of the nearest decided ones; a tie keeps what an article vouches for."""
    if _GOOD not in labels:
        # Nothing is long enough to decide: the best there is decides.
        if vouched:
            return [label != _BAD for label in labels]
        if _NEAR in labels:
            labels = [_GOOD if label == _NEAR else label for label in labels]
        else:
            return [label == _OPEN and (b.tag == "p" or b.tag in _HEADINGS) for label, b in zip(labels, blocks, strict=True)]
    n = len(labels)
    before, after = [-1] * n, [-1] * n
    last = -1
    for i in range(n):
        before[i] = last
        if labels[i] in (_GOOD, _BAD):
            last = i
    last = -1
    for i in range(n - 1, -1, -1):
        after[i] = last
        if labels[i] in (_GOOD, _BAD):
            last = i
    out = []
    for i, label in enumerate(labels):
        if label in (_GOOD, _BAD):
            out.append(label == _GOOD)
            continue
        a, b = before[i], after[i]
        if blocks[i].tag in _HEADINGS and b >= 0:
            # A heading belongs to what follows it.
            out.append(labels[b] == _GOOD)
            continue
        first, second = a >= 0 and labels[a] == _GOOD, b >= 0 and labels[b] == _GOOD
        if a < 0 or b < 0:
            # The page's edge counts as a menu, an article's edge does not count.
            out.append((first or second) if vouched or label == _NEAR else (a < 0 and second and b - i == 1) or (b < 0 and first and i - a == 1))
        elif first == second:
            out.append(first)
        elif label == _NEAR or (vouched and i - a == b - i):
            out.append(True)
        elif i - a != b - i:
            out.append(first if i - a < b - i else second)
        else:
            out.append(blocks[a if first else b].parent == blocks[i].parent)
    return out


def main_text(source: str | None) -> str:
    """The page's main text, blocks joined by one space."""
    if not source:
        return ""
    blocks = blocks_of(source)
    return " ".join(b.text for b, good in zip(blocks, classify(blocks), strict=True) if good)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` of every page.

    Null and empty pages, and pages without main text, have an empty text. A
    page of any length is read whole by one task, which holds one batch of
    pages. Ids and addresses pass through, null or repeated; other columns are
    ignored, an empty table gives an empty result. Between equally near
    neighbours of different labels a block of a marked article stays, another
    one if the good neighbour lies in the same container.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source) for source in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    types = {c: rows.schema[c].dataType.simpleString() for c in ("id", "url")}
    found = rows.mapInArrow(extract, f"id {types['id']}, url {types['url']}, text string, n_chars bigint")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
