"""Job cards from saved listing pages.

Pages are rows of a DataFrame; Spark spreads them over tasks and each task
parses its pages inside ``mapInPandas``.  HTML tree parsing cannot be expressed
with built-in functions, so the Python part is kept to the per-page parse; page
triage, url handling, filtering and dedupe stay JVM-side.

Plainly written markup (quoted or simple attributes, comments, scripts without
oddities) is cut by one regular expression; a page with anything else goes to
the standard library's ``html.parser``, and both give the same elements.

Card rules:
* candidates: every ``div`` whose class attribute contains "job", in
  document order (a nested match yields the card again, as before);
* keep a candidate that has an ``h3``, has no ``form``, and whose text is
  longer than 50 characters; keep the first ``max_cards`` per page;
* title = stripped text of the first ``h3``; url = its ``data-url``, else
  the ``href`` of the first ``a`` in it; relative urls get ``base_url``;
* company = first ``a`` whose href contains "/companies/" and whose text is
  not empty; location = first element with classes text-rich-grey,
  text-truncate and text-nowrap; salary = first ``div`` with class token
  "salary"; skills = texts of the ``a`` tags in the first
  ``div[data-controller=responsive-tag-list]``; a missing field is "N/A".
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections import Counter
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirelens.schemas import JOB_CARD

# The page parser runs in Python workers.  Ship this module's code with the
# task (by value) so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NA = "N/A"
MAX_CARDS = 40
MIN_CARD_TEXT = 50
DEFAULT_BASE_URL = "https://jobs.example.com"

# Page triage markers and thresholds (characters).
CHALLENGE_MARKERS = ["Verify you are human", "Just a moment"]
WAIT_MARKERS = ["Just a moment", "Checking your browser"]
CHALLENGE_MAX_CHARS = 100000
SHORT_PAGE_CHARS = 30000

#: Pages parsed between two output batches of a task.
PAGES_AT_ONCE = 100

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_HIDDEN_TEXT = {"script", "style", "template"}


class _Node:
    """An element; ``idx``..``last`` is its subtree in document order and
    ``t0``..``t1`` the text pieces inside it."""

    __slots__ = ("tag", "attrs", "idx", "last", "t0", "t1")

    def __init__(self, tag, attrs, idx, t0):
        self.tag, self.attrs, self.idx, self.t0 = tag, attrs, idx, t0
        self.last, self.t1 = idx, t0

    def classes(self):
        return (self.attrs.get("class") or "").split()


class _Elements:
    """Elements and text pieces of a page, and what cards ask of them.  Text
    inside script/style/template is recorded as None (not visible text)."""

    def index(self):
        """Prefix counts of characters: a question about a subtree is then a
        binary search, however the elements are nested."""
        self.size = list(accumulate((len(t) if t is not None else 0 for t in self.texts), initial=0))

    def below(self, node, kind):
        """The elements of a kind inside a node, in document order."""
        places = self.places[kind]
        at = bisect_right(places, node.idx)
        while at < len(places) and places[at] <= node.last:
            yield self.nodes[places[at]]
            at += 1

    def first(self, node, kind):
        places = self.places[kind]
        at = bisect_right(places, node.idx)
        return self.nodes[places[at]] if at < len(places) and places[at] <= node.last else None

    def chars(self, node):
        """Characters of the visible text inside a node."""
        return self.size[node.t1] - self.size[node.t0]

    def text(self, node, strip=False):
        if node.t1 - node.t0 == 1:
            text = self.texts[node.t0] or ""
            return text.strip() if strip else text
        parts = [t for t in self.texts[node.t0: node.t1] if t is not None]
        if strip:
            return "".join(p.strip() for p in parts if p.strip())
        return "".join(parts)


class _Doc(_Elements, HTMLParser):
    """Flat pre-order element list by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[_Node] = []
        self.texts: list[str | None] = []
        self.stack: list[_Node] = []
        self.open: Counter[str] = Counter()
        self.hidden = 0

    def _open(self, tag, attrs):
        node = _Node(tag, {k: (v if v is not None else "") for k, v in attrs}, len(self.nodes), len(self.texts))
        self.nodes.append(node)
        return node

    def _close(self, node):
        node.last, node.t1 = len(self.nodes) - 1, len(self.texts)
        self.open[node.tag] -= 1
        if node.tag in _HIDDEN_TEXT:
            self.hidden -= 1

    def handle_starttag(self, tag, attrs):
        node = self._open(tag, attrs)
        if tag in _VOID:
            node.last, node.t1 = node.idx, node.t0
            return
        self.stack.append(node)
        self.open[tag] += 1
        if tag in _HIDDEN_TEXT:
            self.hidden += 1

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs)

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        while True:
            node = self.stack.pop()
            self._close(node)
            if node.tag == tag:
                return

    def handle_data(self, data):
        self.texts.append(None if self.hidden else data)

    def parse_marked_section(self, i, report=1):
        """``<![...`` is a comment up to the next ``>``, as browsers read it
        (the library knows a few such sections only and gives up on others)."""
        end = self.rawdata.find(">", i)
        return -1 if end < 0 else end + 1

    def unknown_decl(self, data):
        pass

    def close(self):
        super().close()
        while self.stack:
            self._close(self.stack.pop())

    def index(self):
        super().index()
        self.places: dict[str, list[int]] = {kind: [] for kind in _KINDS}
        for node in self.nodes:
            for kind, asked in _KINDS.items():
                if asked(node):
                    self.places[kind].append(node.idx)


_WS = "[\\t\\n\\r\\f ]"
_ATTR = rf"""{_WS}+([a-zA-Z_][-a-zA-Z0-9_:.]*)(?:=(?:"([^"&]*)"|'([^'&]*)'|([^\t\n\r\f "'&<>=`/]+)(?=[\t\n\r\f >])))?"""
_ATTRS = re.compile(_ATTR)
_COMMENT = r"<!--(?![->])(?>(?:[^-]|-(?!-))*)-->"
#: Cuts a page into text, markup, text, ..., text; markup that no tag can be stays in the texts.
_MARKUP = re.compile(rf"""({_COMMENT}|<[^<>"']*+(?:"[^"<]*+"[^<>"']*+|'[^'<]*+'[^<>"']*+)*+>|<[^<>]*>)""")
_TOKEN = re.compile(
    rf"</([a-zA-Z][-a-zA-Z0-9]*){_WS}*>"
    rf"|<([a-zA-Z][-a-zA-Z0-9]*)((?>(?:{re.sub(r'[(](?![?])', '(?:', _ATTR)})*)){_WS}*(/?)>"
    rf"|{_COMMENT}|<!(?i:doctype)[\t\n\r\f ][^<>]*>")
#: Elements whose content is no markup, or is none in some releases of the library.
_RAW = {tag: re.compile(rf"</{tag}{_WS}*>", re.I) for tag in ("script", "style", "title", "textarea")}
_ODD = {"iframe", "noembed", "noframes", "noscript", "plaintext", "xmp"}


#: What a piece of markup is, and how many pieces of at most so many characters a task keeps in mind.
_CLOSES, _OPENS, _EMPTY, _OPENS_RAW, _NOTHING, _OTHER = range(6)
KNOWN_PIECES, KNOWN_CHARS = 20_000, 200


def _token(piece: str) -> tuple:
    """(what it is, tag, attributes, kinds of element that cards ask for)."""
    m = _TOKEN.fullmatch(piece)
    if m is None:
        return _OTHER, "", None, ()
    closes, opens, written, slash = m.groups()
    if closes is not None:
        return _CLOSES, closes.lower(), None, ()
    if opens is None:
        return _NOTHING, "", None, ()
    tag = opens.lower()
    if tag in _ODD or (slash and tag in _RAW):
        return _OTHER, tag, None, ()
    attrs = {name.lower(): double or single or bare for name, double, single, bare in _ATTRS.findall(written + ">")}
    asked = _ASKED.get(tag, _ASKED_OF_ANY) if attrs else _ASKED_BARE.get(tag, ())
    what = _EMPTY if slash or tag in _VOID else _OPENS_RAW if tag in _RAW else _OPENS
    return what, tag, attrs, [kind for kind, of in asked if of(attrs)]


class _Plain(_Elements):
    """The same of a plainly written page: ``read`` cuts it by one regular
    expression, or says that the page has other markup.  Only elements that
    cards ask for become nodes.  ``known`` holds tokens of short pieces of
    markup, and may be kept from page to page."""

    def __init__(self, known: dict[str, tuple] | None = None):
        self.nodes: dict[int, _Node] = {}
        self.texts: list[str | None] = []
        self.places: dict[str, list[int]] = {kind: [] for kind in _KINDS}
        self.known = {} if known is None else known

    def _remember(self, piece: str) -> tuple:
        token = _token(piece)
        if len(piece) <= KNOWN_CHARS:
            if len(self.known) >= KNOWN_PIECES:
                self.known.clear()
            self.known[piece] = token
        return token

    def read(self, html: str) -> bool:
        nodes, texts, places, known = self.nodes, self.texts, self.places, self.known
        stack: list[str] = []
        held: list[_Node | None] = []  # by place in the stack
        opened: dict[str, int] = {}
        count = hidden = 0
        pieces = _MARKUP.split(html)
        tail = pieces.pop()
        if "<" in tail or "&" in tail:
            return False  # the library waits for the rest of a tag or reference

        parts = iter(pieces)
        for text, piece in zip(parts, parts):
            if text:
                if "<" in text:
                    return False
                if hidden:
                    texts.append(None)
                else:
                    texts.append(unescape(text) if "&" in text else text)
            what, tag, attrs, kinds = known.get(piece) or self._remember(piece)
            if what == _CLOSES:
                if not opened.get(tag):
                    continue
                top = None
                while top != tag:
                    top, node = stack.pop(), held.pop()
                    opened[top] -= 1
                    if node is not None:
                        node.last, node.t1 = count - 1, len(texts)
                    if top == "template":  # other hidden texts are no markup
                        hidden -= 1
                continue
            if what == _NOTHING:
                continue
            if what == _OTHER:
                return False
            node = None
            if kinds:
                node = nodes[count] = _Node(tag, attrs, count, len(texts))
                for kind in kinds:
                    places[kind].append(count)
            count += 1
            if what == _OPENS:
                stack.append(tag)
                held.append(node)
                opened[tag] = opened.get(tag, 0) + 1
                if tag == "template":
                    hidden += 1
            elif what == _OPENS_RAW:
                inside = self._raw(parts, tag)
                if inside is None:
                    return False
                if tag in _HIDDEN_TEXT:
                    texts.append(None)
                elif inside:
                    texts.append(None if hidden else unescape(inside))
                if node is not None:
                    node.t1 = len(texts)
        if tail:
            texts.append(None if hidden else tail)
        for node in held:
            if node is not None:
                node.last, node.t1 = count - 1, len(texts)
        return True

    @staticmethod
    def _raw(parts, tag: str) -> str | None:
        """The content up to the end tag; None if it isn't plain."""
        inside: list[str] = []
        for text, piece in zip(parts, parts):
            inside.append(text)
            if _RAW[tag].fullmatch(piece):
                content = "".join(inside)
                other = "<!--" in content or f"</{tag}" in content.lower() if tag in _HIDDEN_TEXT else "<" in content
                return None if other else content
            inside.append(piece)
        return None


def normalize_url(url, base_url=DEFAULT_BASE_URL):
    if url and url != NA and not url.startswith("http"):
        return base_url + url
    return url


# The card selectors.
_LOCATION_CLASSES = {"text-rich-grey", "text-truncate", "text-nowrap"}
_KINDS = {
    "job": lambda n: n.tag == "div" and "job" in (n.attrs.get("class") or ""),
    "h3": lambda n: n.tag == "h3",
    "form": lambda n: n.tag == "form",
    "a": lambda n: n.tag == "a",
    "company": lambda n: n.tag == "a" and "/companies/" in (n.attrs.get("href") or ""),
    "location": lambda n: _LOCATION_CLASSES.issubset(n.classes()),
    "salary": lambda n: n.tag == "div" and "salary" in n.classes(),
    "skills": lambda n: n.tag == "div" and n.attrs.get("data-controller") == "responsive-tag-list",
}
# The same by tag, of an element's attributes; without attributes only the tag can tell.
_LOCATED = ("location", lambda attrs: _LOCATION_CLASSES.issubset(attrs.get("class", "").split()))
_ASKED_BARE = {tag: ((tag, lambda attrs: True),) for tag in ("h3", "form", "a")}
_ASKED_OF_ANY = (_LOCATED,)
_ASKED = {
    "div": (("job", lambda attrs: "job" in attrs.get("class", "")),
            ("salary", lambda attrs: "salary" in attrs.get("class", "").split()),
            ("skills", lambda attrs: attrs.get("data-controller") == "responsive-tag-list"), _LOCATED),
    "a": (*_ASKED_BARE["a"], ("company", lambda attrs: "/companies/" in attrs.get("href", "")), _LOCATED),
    "h3": (*_ASKED_BARE["h3"], _LOCATED),
    "form": (*_ASKED_BARE["form"], _LOCATED),
}


def parse_card(doc: _Doc, card: _Node, base_url: str = DEFAULT_BASE_URL) -> dict:
    h3 = doc.first(card, "h3")
    if h3 is not None:
        title = doc.text(h3, strip=True)
        url = h3.attrs.get("data-url")
        if not url:
            a = doc.first(h3, "a")
            if a is not None:
                url = a.attrs.get("href")
    else:
        title, url = NA, NA
    company = next((t for t in (doc.text(a, strip=True) for a in doc.below(card, "company")) if t), NA)
    location, salary, tags = (doc.first(card, kind) for kind in ("location", "salary", "skills"))
    return {
        "title": title,
        "url": normalize_url(url, base_url),
        "company": company,
        "location": doc.text(location, strip=True) if location is not None else NA,
        "salary": doc.text(salary, strip=True) if salary is not None else NA,
        "skills": [doc.text(a, strip=True) for a in doc.below(tags, "a")] if tags is not None else [],
    }


def cards_in_page(html: str | None, max_cards: int = MAX_CARDS, base_url: str = DEFAULT_BASE_URL,
                  known: dict[str, tuple] | None = None):
    """Parsed cards of one whole page, in document order (at most max_cards).
    If the parser gives up on a page, its cards up to there carry the error
    in ``parse_error``; other pages go on."""
    if not html:
        return []
    doc, error = _Plain(known), None
    if not doc.read(html):
        doc = _Doc()
        try:
            doc.feed(html)
            doc.close()
        except Exception as e:  # what the page's author wrote must not end the job
            error = f"{type(e).__name__}: {e}"[:200]
            while doc.stack:
                doc._close(doc.stack.pop())
    doc.index()
    out = []
    for place in doc.places["job"]:
        node = doc.nodes[place]
        if doc.first(node, "h3") is None or doc.first(node, "form") is not None:
            continue
        if doc.chars(node) <= MIN_CARD_TEXT:
            continue
        out.append(parse_card(doc, node, base_url) | {"parse_error": error})
        if len(out) == max_cards:
            # The cap is the feature: the whole page has been parsed above.
            break
    return out


def job_cards(pages: DataFrame, max_cards: int = MAX_CARDS, base_url: str = DEFAULT_BASE_URL,
              scraped_at: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, html) rows -> one row per card, ``pos`` = 1-based order.

    ``carry`` names page columns copied onto each of its cards (for example
    the scrape batch), so no join back to the pages is needed.
    """
    schema = StructType(JOB_CARD.fields + [pages.schema[c] for c in carry])
    parsed = [f.name for f in JOB_CARD.fields if f.name not in ("page_id", "pos")]

    def parse(batches):
        known: dict[str, tuple] = {}
        for whole in batches:
            for start in range(0, len(whole), PAGES_AT_ONCE):
                pages = whole.iloc[start:start + PAGES_AT_ONCE]
                page, pos, cards = [], [], []
                for i, html in enumerate(pages["html"]):
                    found = cards_in_page(html, max_cards, base_url, known)
                    page += [i] * len(found)
                    pos += range(1, len(found) + 1)
                    cards += found
                if not cards:  # an empty list has no type for Arrow
                    continue
                yield pd.DataFrame({"page_id": pages["page_id"].array.take(page), "pos": pos,
                                    **{c: [card[c] for card in cards] for c in parsed},
                                    **{c: pages[c].array.take(page) for c in carry}})

    # Exact JVM-side pre-filter: a card needs a class attribute containing
    # "job", so its page contains "job" literally or has some of its letters
    # as character references.  Other pages have no card and never reach Python.
    html = F.col("html")
    src = pages.select("page_id", "html", *carry).where(html.contains("job") | html.contains("&"))
    out = src.mapInPandas(parse, schema)
    stamp = F.lit(scraped_at) if scraped_at else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return out.withColumn("scraped_at", stamp)


def valid_cards(cards: DataFrame) -> DataFrame:
    """Drop junk cards: title or url equal to "N/A" (a NULL url is kept)."""
    return cards.where(~F.col("title").eqNullSafe(F.lit(NA)) & ~F.col("url").eqNullSafe(F.lit(NA)))


def page_triage(pages: DataFrame, challenge_max: int = CHALLENGE_MAX_CHARS,
                short_below: int = SHORT_PAGE_CHARS) -> DataFrame:
    """Flag pages JVM-side (lengths in characters):

    * ``is_challenge``: a challenge marker on a page of at most
      ``challenge_max`` characters (a larger page is a false positive);
    * ``needs_wait``: a browser-check marker, on which a fetch waits and
      re-reads the page;
    * ``is_short``: fewer than ``short_below`` characters (maybe blocked).
    Triage only drives retries; every page is still parsed.
    """
    html = F.col("html")
    n = F.length(html)

    def any_of(markers) -> Column:
        out: Column = F.lit(False)
        for m in markers:
            out = out | html.contains(m)
        return out

    challenge = any_of(CHALLENGE_MARKERS) & (n <= challenge_max)
    short = n < short_below
    return pages.select(
        "page_id", n.alias("n_chars"), challenge.alias("is_challenge"),
        any_of(WAIT_MARKERS).alias("needs_wait"), short.alias("is_short"),
        F.when(challenge, "challenge").when(short, "short").otherwise("ok").alias("page_status"))
