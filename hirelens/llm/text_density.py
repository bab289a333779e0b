"""Main text of HTML pages by composite text density.

Per page: a tolerant tokenizer builds the element tree; parts that are never
article text (scripts, menus, forms, asides, adverts, comments ...) are
closed off, but for what the article lies in; every remaining node gets a
composite density, its characters per tag adjusted by its links; nodes add up
their children's densities; the node with the largest sum fixes a threshold,
the least density on its path to the body; wherever a node reaches that
threshold, the largest-sum node below it is taken, whole (of equal sums the
outer one).  Pages are independent, so there is no shuffle; each is parsed
whole in one task, in time linear in its length, however it is nested.
"""

from __future__ import annotations

import html as _html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from hirelens.llm.common import text_slices

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(>|\Z)", re.S)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside".split())
#: Elements that are no article text, wherever they stand.
_DROP = frozenset(
    "head script style title noscript template iframe object svg canvas nav footer aside form button select textarea "
    "fieldset dialog menu xmp noembed noframes audio video".split())
#: Words of class, id or role that only name parts that are no article text ...
_SURE = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored navbar breadcrumb breadcrumbs sidebar "
    "masthead cookie cookies consent popup modal comment comments disqus newsletter subscribe subscription signup "
    "pagination pager toolbar complementary contentinfo alertdialog".split())
#: ... and others that may also be about something (``search-algorithms``).
_MARKS = _SURE | frozenset(
    "promo promotion banner nav navigation menu footer notice notices overlay share sharing social related login widget "
    "search alert dialog".split())
#: Words that beside a mark say nothing of the content.
_FRAME = frozenset(
    "box boxes block area panel wrap wrapper container inner outer section region bar list item items link links button "
    "buttons icon icons form field header head title top bottom left right upper lower main site page global user users "
    "reader readers visitor post posts article articles story stories content widget module component slot unit row "
    "column col card cards tag tags this us bar strip zone holder js ui".split())
#: Words that make a compound the state of a page, not the name of a part (``has-sidebar``).
_STATE = frozenset("has no not with without is hide hidden".split())
#: Text that an openable marked part must hold, as a multiple of what is left without it, to count as the article's frame.
_FRAME_SHARE = 4
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I | re.S)
_WORD = re.compile(r"[a-z]+")
#: Open tags that end an open element of the listed kinds (inside one list, table or select).
_ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
         "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
         "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
#: A paragraph or part of a line alone is no article.
_INLINE = frozenset("p b i em strong span font a".split())
#: Marked parts within each other that are looked into one by one.
_TURNS = 8
_TABLE = frozenset("table caption thead tbody tfoot tr td th".split())
_HEAD = frozenset("title meta link style script base noscript template".split())


def _mark(attrs: str) -> int:
    """3: the class, id or role surely names no article text; 2: it seems to
    (a whole name, or all its words do); 1: a word of it might; 0: nothing."""
    mark = 0
    for m in _ATTR.finditer(attrs):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            words = set(_WORD.findall(name))
            if words.isdisjoint(_MARKS) or not words.isdisjoint(_STATE):
                continue
            if not words.isdisjoint(_SURE):
                return 3
            mark = max(mark, 2 if words <= _MARKS | _FRAME else 1)
    return mark


class _Page:
    """The element tree as parallel lists: parents come before children."""

    def __init__(self) -> None:
        self.tag, self.parent, self.dropped = ["#root"], [-1], [False]
        #: How surely a node is marked as no article text (see ``_mark``).
        self.marked = [0]
        #: (node, text) in page order; a text of None is the edge of a block.
        self.pieces: list[tuple[int, str | None]] = []
        self.open = [0]
        #: Places in ``open`` of each tag, of blocks and of parts of tables.
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.tables: list[int] = []

    def last(self, tags) -> int:
        """Place of the innermost open element of some tags; 0 if there is none."""
        if tags is _BLOCK or tags is _TABLE:
            places = self.blocks if tags is _BLOCK else self.tables
            return places[-1] if places else 0
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def shut(self, place: int) -> None:
        """Close the open elements from a place on."""
        while len(self.open) > place:
            tag = self.tag[self.open.pop()]
            self.at[tag].pop()
            if tag in _BLOCK:
                self.blocks.pop()
            if tag in _TABLE:
                self.tables.pop()

    def push(self, tag: str, attrs: str) -> None:
        up = self.open[-1]
        drop = self.dropped[up] or tag in _DROP
        if not drop and tag == "header":
            drop = not self.last(("article", "main"))
        named = not drop and attrs and tag not in ("html", "body", "article", "main")
        self.marked.append(_mark(attrs) if named else 0)
        self.tag.append(tag)
        self.parent.append(up)
        self.dropped.append(drop)
        if tag in _BLOCK:
            self.pieces.append((0, None))
        elif tag == "br":
            self.pieces.append((up, " "))
        if tag not in _VOID:
            place = len(self.open)
            self.open.append(len(self.tag) - 1)
            self.at.setdefault(tag, []).append(place)
            if tag in _BLOCK:
                self.blocks.append(place)
            if tag in _TABLE:
                self.tables.append(place)

    def close_to(self, tags: tuple[str, ...], stop: tuple[str, ...] | frozenset) -> bool:
        """Close the nearest open element of ``tags``, with what is open
        inside it, unless one of ``stop`` stands in between."""
        place = self.last(tags)
        if not place or self.last(stop) > place:
            return False
        if self.last(_BLOCK) >= place:
            self.pieces.append((0, None))
        self.shut(place)
        return True

    def start(self, tag: str, attrs: str) -> None:
        if self.tag[self.open[-1]] == "head" and tag not in _HEAD:
            self.shut(len(self.open) - 1)
        if tag in _BLOCK:
            self.close_to(("p",), _TABLE)
        if tag in _ENDS:
            ended, inside = _ENDS[tag]
            while self.close_to(ended, inside):
                pass
        self.push(tag, attrs)

    def end(self, tag: str) -> None:
        if tag in _TABLE or tag == "head":
            self.close_to((tag,), ())
        elif tag not in ("body", "html"):  # what follows these still belongs to the body
            closed = self.close_to((tag,), _TABLE if tag in _BLOCK else _BLOCK)
            if tag == "p" and not closed:  # stands for an empty paragraph
                self.pieces.append((0, None))


def parse(markup: str) -> _Page:
    page, at, end = _Page(), 0, len(markup)
    while at < end:
        m = _TOKEN.search(markup, at)
        stop = m.start() if m else end
        if stop > at:
            page.pieces.append((page.open[-1], _html.unescape(markup[at:stop])))
        if m is None:
            break
        at = m.end()
        name = m[2] or m[6]
        if name is None:
            if m[0].startswith("<![CDATA["):
                page.pieces.append((page.open[-1], m[0][9:].removesuffix("]]>")))
            continue
        if not (m[4] or m[8]):  # the page ends inside a tag
            break
        tag = name.lower()
        if m[1] or m[5]:
            page.end(tag)
            continue
        page.start(tag, m[3] or m[7] or "")
        if tag in _RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(markup, at)
            at = close.start() if close else end
    return page


def drop_marked(page: _Page) -> None:
    """Drop the marked parts, but none that the article lies in: not the
    parents of the largest article or main element (one in a surely marked part
    only if there is no other), nor, of parts that only seem to be none, what
    holds nearly all text.  What a single word might mark (``related-work``)
    belongs to the article if it lies in it (in its element or, without one, in
    the densest part) and is not mostly links."""
    if not any(page.marked):
        return
    n, base = len(page.tag), page.dropped
    chars, links = _sizes(page)
    sure, some = [False] * n, []
    for i in range(1, n):
        sure[i] = sure[page.parent[i]] or page.marked[i] == 3
        if page.tag[i] in ("article", "main") and chars[i] and not base[i]:
            some.append((not sure[i], page.tag[i] == "article", chars[i], -i))
    region, opened = -max(some)[3] if some else 0, [False] * n
    up = region
    while up > 0:
        opened[up], up = True, page.parent[up]

    for turn in range(_TURNS + 1):
        page.dropped, left, frames = base[:], 0, []
        for i in range(1, n):
            if page.dropped[page.parent[i]]:
                page.dropped[i] = True
            elif not page.dropped[i] and page.marked[i] >= 2 and not opened[i]:
                page.dropped[i] = True
                frames.append(i)
        inside = _below(page, region)
        left = sum(size for i, size in enumerate(_own(page)) if inside[i] and not page.dropped[i])
        frames = [i for i in frames if inside[i] and chars[i] and (
            not left or page.marked[i] == 2 and chars[i] > _FRAME_SHARE * left)]
        if not frames:
            break
        if turn == _TURNS:  # nested without end: none of them counts
            opened = [True] * n
        opened[max(frames, key=lambda i: (page.marked[i] == 2, chars[i], -i))] = True

    if 1 not in page.marked:
        return
    if not region:
        density, total, body = _densities(page)
        region = max(range(body, n), key=lambda i: (total[i] if not page.dropped[i] else -1, -i))
        while region > body and page.tag[region] in _INLINE:
            region = page.parent[region]
        up = region
        while up > 0:
            opened[up], up = True, page.parent[up]
    inside = _below(page, region)
    for i in range(1, n):
        page.dropped[i] = page.dropped[i] or page.dropped[page.parent[i]] or (
            page.marked[i] == 1 and not opened[i] and not (inside[i] and 2 * links[i] < chars[i]))


def _below(page: _Page, top: int) -> list[bool]:
    """Whether each node is ``top`` or lies in it."""
    out = [False] * len(page.tag)
    out[top] = True
    for i in range(top + 1, len(out)):
        out[i] = out[page.parent[i]]
    return out


def _own(page: _Page) -> list[int]:
    """Characters but white space of every node's own text."""
    out = [0] * len(page.tag)
    for node, text in page.pieces:
        if text:
            out[node] += len("".join(text.split()))
    return out


def _sizes(page: _Page) -> tuple[list[int], list[int]]:
    """Characters of every node that isn't dropped, with all below it; and those of them in links."""
    n = len(page.tag)
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[page.parent[i]] or page.tag[i] == "a"
    chars = [0 if d else c for c, d in zip(_own(page), page.dropped)]
    links = [c * x for c, x in zip(chars, in_link)]
    for i in range(n - 1, 0, -1):
        if not page.dropped[i]:
            chars[page.parent[i]] += chars[i]
            links[page.parent[i]] += links[i]
    return chars, links


def _densities(page: _Page) -> tuple[list[float], list[float], int]:
    """Composite density and density sum of every node, and the body."""
    n = len(page.tag)
    own, chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in page.pieces:
        if text and not page.dropped[node]:
            own[node] += len("".join(text.split()))
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[page.parent[i]] or page.tag[i] == "a"
    for i in range(n - 1, -1, -1):
        chars[i] += own[i]
        if in_link[i]:
            link_chars[i] = chars[i]
        up = page.parent[i]
        if up >= 0 and not page.dropped[i]:
            chars[up] += chars[i]
            tags[up] += tags[i] + 1
            link_chars[up] += link_chars[i]
            link_tags[up] += link_tags[i] + (page.tag[i] == "a")
    body = next((i for i in range(n) if page.tag[i] == "body" and not page.dropped[i]), 0)
    share = link_chars[body] / max(chars[body], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c = chars[i]
        if not c:
            continue
        t, lc, lt = max(tags[i], 1), max(link_chars[i], 1), max(link_tags[i], 1)
        base = 1 + math.log(c / max(c - link_chars[i], 1) * link_chars[i] + share * c + math.e)
        density[i] = c / t * math.log(max(c / lc * t / lt, 1.0) + 1) / math.log(base)
        total[i] += own[i]
        if page.parent[i] >= 0 and not page.dropped[i]:
            total[page.parent[i]] += density[i]
    return density, total, body


def main_text(markup: str | None) -> str:
    """The article's blocks, joined by line feeds; empty if there is none."""
    if not markup:
        return ""
    page = parse(markup)
    drop_marked(page)
    n = len(page.tag)
    density, total, body = _densities(page)
    inside = [False] * n
    inside[body] = True
    for i in range(body + 1, n):
        inside[i] = inside[page.parent[i]] and not page.dropped[i]
    best = list(range(n))  # the largest-sum node of each subtree; of equal ones the outer
    for i in range(n - 1, body, -1):
        up = page.parent[i]
        if inside[i] and total[best[i]] > total[best[up]]:
            best[up] = best[i]
    top, threshold = best[body], math.inf
    while top >= body:
        threshold = min(threshold, density[top])
        if top == body:
            break
        top = page.parent[top]
    # Of every node the nearest that is more than a line, and the nearest article.
    whole, article = list(range(n)), [-1] * n
    for i in range(body, n):
        if i > body and page.tag[i] in _INLINE:
            whole[i] = whole[page.parent[i]]
        article[i] = i if page.tag[i] == "article" else article[page.parent[i]] if i > body else -1
    chosen = [False] * n
    for i in range(body, n):
        if inside[i] and density[i] >= threshold and density[i] > 0:
            pick = whole[best[i]]
            chosen[article[pick] if article[pick] >= 0 else pick] = True
    for i in range(body + 1, n):
        chosen[i] = inside[i] and (chosen[i] or chosen[page.parent[i]])
    blocks, held = [], []
    for node, text in [*page.pieces, (0, None)]:
        if text is None:
            blocks.append(" ".join("".join(held).split()))
            held = []
        elif chosen[node]:
            held.append(text)
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) per input row; null or empty html gives an
    empty text.  Repeated rows and null ids each give one row, an empty table
    gives none; other columns, whatever their names, are not read."""
    rows = pages.select(pages[id_col].alias(id_col), pages[url_col].alias(url_col), pages[html_col].alias("text"))
    kinds = [rows.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches):
        for batch in batches:
            for part, _, _ in text_slices(batch):
                texts = [main_text(x) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(x) for x in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return rows.mapInArrow(run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars bigint")
