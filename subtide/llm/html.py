"""The main text of web pages by line-block distribution.

1. Markup is stripped into lines: one line per block of text. Scripts and styles leave nothing. Forms,
   menus, headers, footers and asides leave ``GAP`` empty lines, and elements that are hidden, or
   that are named as an advert, a sidebar, a notice, comments and the like, leave one. If the page
   marks an article or a main element, lines outside of it are empty too. In other pages a line that
   is mostly link text counts as empty when text is looked for.
2. Text lengths are summed over sliding windows of ``GAP`` lines. Where the sum rises from zero is a
   surge point, where it falls back to zero a dive point.
3. With an article or main element, the text between surge and dive is kept. In other pages the
   stretches whose largest window reaches ``THRESHOLD`` characters, or else the one with most text,
   only say where the text is: all lines of the smallest block element around them are kept, however
   short. That element has to hold two lines or more, and a paragraph, a list, a section and the like
   are parts of it; if there is none it is the page.

Inside of an article an element is dropped by a class only if it names an advert, a sidebar, a menu, a
notice or comments, and a heading, a paragraph or the like only if it names an advert or comments:
sections of a discussion, teasers or search results may be what the article is about.

An element is named by a class or role as a whole: ``sidebar``, or words that say no more, as in
``left-sidebar`` or ``comment-list``, but not ``has-sidebar`` or ``search-algorithms``. An id counts in
the same way, but never for headings, paragraphs, lists, tables and the like, nor for a section of an
article unless it names comments. An element with more than half of the page's text outside of menus,
footers, asides and so on is not dropped for its name, unless that names comments or cookies.

A main element gives way to the article inside of it if there is one and it holds more than half of
the main element's text. Otherwise the main element is kept with all its articles.

Character references are decoded once, white space inside a line becomes one space, lines are trimmed
and joined by one space in page order. Nothing else is changed, dropped or cut.

Defined cases: NULL or empty html gives the empty string. Markup that is cut off or never closed ends
with the page; a boilerplate element that is never closed ends at the next block. Repeated rows give
repeated rows, extra columns are ignored. A page is one row of a narrow scan: no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Lines in a window, and empty lines for a dropped element.
GAP = 3
THRESHOLD = 80
LINK_SHARE = 0.6

# Elements by what they do to the text.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
DROPPED = frozenset(
    "head script style noscript template nav menu footer aside form button select textarea dialog "
    "iframe object embed svg canvas audio video map title xmp noembed noframes fieldset".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr img".split()
)
# Words in a class, id or role that name something other than the article.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner promo promotion sponsor "
    "sponsored sidebar sidebars rail nav navbar navigation menu menubar breadcrumb breadcrumbs cookie "
    "cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup "
    "popup modal overlay footer masthead topbar toolbar comment comments commentlist respond replies "
    "disqus discussion share sharing social related recommended recommendations widget widgets login "
    "search copyright disclaimer paywall contentinfo complementary skip feedback responses teaser "
    "teasers trending popular announcement announcements toast pagination pager".split()
)
# Those that drop an element inside of the article: adverts, sidebars, menus and links, notices, comments.
ADVERT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense adbox sponsored".split())
IN_ARTICLE = ADVERT_WORDS | frozenset(
    "banner promo promotion sponsor sidebar sidebars rail nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs cookie cookies consent gdpr notice notices notification alert newsletter subscribe "
    "subscription signup popup modal overlay footer masthead comment comments commentlist respond replies "
    "disqus share sharing pagination pager".split()
)
# Words beside one of these that say where or how it is shown, not what it is about.
LAYOUT = frozenset(
    "area article articles bar bars block body bottom box boxes button buttons col column container "
    "content desktop entry field fixed floating form global google group heading icon icons image img "
    "inner item items large leaderboard left link links list main mobile outer page panel post posts "
    "primary region right row secondary section site slot small sticky text the title top unit upper "
    "lower wide wrap wrapper wp zone".split()
)
# Around a header these say that it is the page's, not that of a part of the text.
PAGE_LAYOUT = frozenset("bar container global inner outer site sticky top wrap wrapper".split())
# Elements that are the text itself: their id is an anchor.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd blockquote pre figure table section".split())
# Inside of the article only adverts and comments among them are dropped by a class.
KEPT_PROSE = PROSE - frozenset("ul ol section".split())
# Elements inside of the one that encloses a page's text.
PARTS = frozenset(
    "h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd blockquote pre figure figcaption table caption colgroup "
    "thead tbody tfoot tr section details summary hgroup address".split()
)
# A header named with one of these belongs to the article.
ARTICLE_WORDS = frozenset("article entry post story content main".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond".split())
BODY_WORDS = frozenset("articlebody".split())
# Dropped by name however much text they hold.
ALWAYS_WORDS = COMMENT_WORDS | frozenset("commentlist disqus cookie cookies consent gdpr".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.S,
)
NAMES = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
UNSEEN = "\0"
HIDDEN = re.compile(r"display\s*:\s*none|aria-hidden\s*=\s*[\"']?true|\shidden(?=[\s=/]|$)", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Names:
    """What an element's class, id, role and itemprop say.

    ``words`` are all their words, with a mark for what is not shown. ``kinds`` and ``id_kinds`` are the
    words of ``BOILERPLATE`` and "header" that a whole value names, by class, role or itemprop and by id.
    """

    __slots__ = ("words", "kinds", "id_kinds")

    def __init__(self, attributes: str):
        self.words: set[str] = {UNSEEN} if HIDDEN.search(attributes) else set()
        self.kinds: set[str] = set()
        self.id_kinds: set[str] = set()
        for attribute, value in NAMES.findall(attributes):
            kinds = self.id_kinds if attribute.lower() == "id" else self.kinds
            for name in value.strip("\"'").split():
                parts = {w.lower() for w in WORD.findall(name)}
                self.words |= parts | {name.lower()}
                named = parts & BOILERPLATE
                if named and parts <= BOILERPLATE | LAYOUT:
                    kinds |= named
                elif "header" in parts and parts <= PAGE_LAYOUT | {"header"}:
                    kinds.add("header")


NAMELESS = Names("")


def tokens(html: str) -> list[tuple]:
    """("text", string), ("open", name, Names) and ("close", name), raw elements left out."""
    out: list[tuple] = []
    at = 0
    while at < len(html):
        match = TOKEN.search(html, at)
        if match is None:
            out.append(("text", html[at:]))
            break
        if match.start() > at:
            out.append(("text", html[at : match.start()]))
        at = match.end()
        name = (match.group(2) or "").lower()
        if not name:
            continue
        if match.group(1):
            out.append(("close", name))
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*[^>]*(?:>|$)", re.I).search(html, at)
            at = end.end() if end else len(html)
            out.append(("raw", name))
            continue
        out.append(("open", name, Names(match.group(3)) if match.group(3) else NAMELESS))
        if name in VOID or match.group(3).endswith("/"):
            out[-1] = ("void", name)
    return out


def closings(found: list[tuple]) -> dict[int, int]:
    """For each opening token its closing one, if there is one."""
    stacks: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for i, token in enumerate(found):
        if token[0] == "open":
            stacks.setdefault(token[1], []).append(i)
        elif token[0] == "close" and stacks.get(token[1]):
            ends[stacks[token[1]].pop()] = i
    return ends


def amounts(found: list[tuple], ends: dict[int, int]) -> list[int]:
    """Characters of text before each token, without those in dropped elements by tag."""
    out = [0] * (len(found) + 1)
    skipped = 0
    for i, token in enumerate(found):
        if token[0] == "open" and token[1] in DROPPED and i in ends:
            skipped = max(skipped, ends[i])
        text = token[0] == "text" and i >= skipped
        out[i + 1] = out[i] + (len("".join(token[1].split())) if text else 0)
    return out


def marked_parts(found: list[tuple], ends: dict[int, int], chars: list[int]) -> list[tuple[int, int]]:
    """(start, end) of the elements that the page marks as its text."""
    parts = [
        (i, ends.get(i, len(found)))
        for i, t in enumerate(found)
        if t[0] == "open"
        if t[1] in ("article", "main") or BODY_WORDS & t[2].words or t[2].words == {"main"}
        if not COMMENT_WORDS & (t[2].kinds | t[2].id_kinds)
    ]
    for a, b in [p for p in parts if found[p[0]][1] == "main"]:
        inner = [(c, d) for c, d in parts if found[c][1] == "article" and a < c and d <= b]
        if any(2 * (chars[d] - chars[c]) > chars[b] - chars[a] for c, d in inner):
            parts.remove((a, b))
    return parts


def lines(html: str) -> tuple[list[tuple[str, int]], list[tuple[int, int]] | None]:
    """(text, weight) of each line in page order, and, unless the page marks its text, the block
    elements that may enclose it, as (first line, end of lines)."""
    found = tokens(html)
    ends = closings(found)
    chars = amounts(found, ends)
    article = marked_parts(found, ends, chars)
    largest = max(article, key=lambda ab: ab[1] - ab[0], default=(-1, -1))[0]
    inside = [False] * (len(found) + 1)
    for a, b in article:
        inside[a:b] = [True] * (min(b, len(found)) - a)

    def spared(i: int) -> bool:
        """Around the largest marked part, or with most of the page's text and dropped by name only."""
        if i <= largest < ends.get(i, i + 1):
            return True
        name, names = found[i][1], found[i][2]
        by_tag = name in DROPPED or name == "header" or UNSEEN in names.words
        if by_tag or ALWAYS_WORDS & (names.kinds | names.id_kinds):
            return False
        return i in ends and 2 * (chars[ends[i]] - chars[i]) > chars[-1]

    out: list[tuple[str, int]] = []
    held: list[str] = []
    linked = depth = 0
    opened: dict[int, int] = {}
    blocks: list[tuple[int, int]] = []

    def end_line() -> None:
        nonlocal linked
        text = " ".join("".join(held).split())
        if text:
            weight = len(text)
            if article and not was_inside or not article and linked >= LINK_SHARE * weight:
                weight = 0
            out.append((text, weight))
        held.clear()
        linked = 0

    i, was_inside = 0, False
    while i < len(found):
        kind, value = found[i][0], found[i][1]
        if kind == "text":
            held.append(unescape(value))
            was_inside = inside[i]
            linked += len(value.strip()) if depth else 0
        elif kind == "raw" or kind == "open" and _dropped(found[i], inside[i]) and not spared(i):
            end_line()
            if kind == "open":
                out += [("", 0)] * (GAP if value in DROPPED or value == "header" else 1)
            if kind == "open":
                i = ends[i] + 1 if i in ends else _next_block(found, i)
                continue
        elif value == "br" or value == "hr":
            end_line()
        elif value == "a":
            depth = depth + 1 if kind == "open" else max(0, depth - 1)
        elif value not in INLINE:
            end_line()
            if kind == "open" and i in ends and value not in PARTS:
                opened[ends[i]] = len(out)
            elif i in opened:
                blocks.append((opened[i], len(out)))
        i += 1
    end_line()
    return out, None if article else blocks


def _dropped(token: tuple, in_article: bool) -> bool:
    name, names = token[1], token[2]
    if name in ("html", "body"):
        return False
    if name in ("article", "main"):
        return bool(COMMENT_WORDS & (names.kinds | names.id_kinds))
    kinds = names.kinds
    if name not in PROSE or name == "section" and (not in_article or COMMENT_WORDS & names.id_kinds):
        kinds = kinds | names.id_kinds
    if in_article:
        kinds = kinds & (ADVERT_WORDS | COMMENT_WORDS if name in KEPT_PROSE else IN_ARTICLE | {"header"})
    header = name == "header" or "header" in kinds and not ARTICLE_WORDS & names.words
    named = UNSEEN in names.words or bool(kinds - {"header"})
    return name in DROPPED or header and not in_article or named


def _next_block(found: list[tuple], start: int) -> int:
    """Where an element that is never closed ends: at the next block, or with the page."""
    for i in range(start + 1, len(found)):
        if found[i][0] != "text" and found[i][1] not in INLINE:
            return i
    return len(found)


def stretches(weights: list[int]) -> list[tuple[int, int, int]]:
    """(first line, last line, largest window) between each surge and the next dive."""
    sums = [sum(weights[i : i + GAP]) for i in range(len(weights))]
    out: list[tuple[int, int, int]] = []
    i = 0
    while i < len(sums):
        if sums[i] == 0:
            i += 1
            continue
        surge = i
        while i < len(sums) and sums[i] > 0:
            i += 1
        out.append((surge, i - 1, max(sums[surge:i])))
    return out


def enclosing(blocks: list[tuple[int, int]], found: list[tuple[str, int]], first: int, last: int) -> range:
    """The lines of the smallest block element of two lines or more around two lines."""
    texts = [0]
    for text, _ in found:
        texts.append(texts[-1] + bool(text))
    around = [(b - a, a, b) for a, b in blocks if a <= first and last < b and texts[b] - texts[a] > 1]
    _, start, end = min(around, default=(0, 0, len(found)))
    return range(start, end)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    found, blocks = lines(html)
    weights = [w for _, w in found]
    kept = stretches(weights)
    if blocks is None:
        return " ".join(found[i][0] for a, b, _ in kept for i in range(a, b + 1) if weights[i])
    strong = [s for s in kept if s[2] >= THRESHOLD]
    strong = strong or sorted(kept, key=lambda s: -sum(weights[s[0] : s[1] + 1]))[:1]
    heavy = [i for a, b, _ in strong for i in range(a, b + 1) if weights[i]]
    rows = enclosing(blocks, found, heavy[0], heavy[-1]) if heavy else range(len(found))
    return " ".join(found[i][0] for i in rows if found[i][0])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
        columns.append(pa.array([len(t) for t in texts], pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Rows of (page_id, url, text, n_chars), one per page."""
    read = pages.select(F.col("page_id").cast("long"), "url", "html")
    return read.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
