"""Card extraction on hand-made pages (nested cards, cap, filters)."""

import random
import time

import pytest

from hirelens.sources import html_cards
from hirelens.sources.html_cards import cards_in_page, job_cards, page_triage, valid_cards

CARD = ('<div class="ipy-2 job-card"><h3 data-url="/it-jobs/{k}"> <a href="https://x/{k}">Title {k}</a> </h3>'
        '<a href="/companies/c"><img src=l></a><a href="/companies/c"> Acme &amp; Co</a>'
        '<div class="fw salary">$1000 - $2000</div>'
        '<span class="text-nowrap text-rich-grey text-truncate">Ha Noi</span>'
        '<div data-controller="responsive-tag-list"><a>Java</a><a> SQL </a></div>'
        '<p>' + "lorem " * 10 + '</p></div>')


def page(*cards):
    return '<html><script>var t="<div class=job><h3>x</h3>";</script>' + "".join(cards) + "</html>"


def test_card_fields():
    (c,) = cards_in_page(page(CARD.format(k=1)), base_url="https://b")
    assert c == {"title": "Title 1", "url": "https://b/it-jobs/1", "company": "Acme & Co",
                 "location": "Ha Noi", "salary": "$1000 - $2000", "skills": ["Java", "SQL"], "parse_error": None}


def test_href_fallback_and_missing_fields():
    html = page('<div class="job"><h3><a href="https://x/9">T</a></h3><p>' + "z" * 60 + "</p></div>")
    (c,) = cards_in_page(html)
    assert c["url"] == "https://x/9"
    assert (c["company"], c["location"], c["salary"], c["skills"]) == ("N/A", "N/A", "N/A", [])


def test_nested_card_yields_twice():
    html = page('<div class="jobs-list">' + CARD.format(k=2) + "</div>")
    cards = cards_in_page(html)
    assert len(cards) == 2 and cards[0] == cards[1]


def test_filters_and_cap():
    no_h3 = '<div class="job">' + "x" * 80 + "</div>"
    with_form = CARD.format(k=3).replace("<p>", "<form></form><p>")
    short = '<div class="job"><h3>t</h3>short</div>'
    html = page(no_h3, with_form, short, *[CARD.format(k=i) for i in range(10, 20)])
    cards = cards_in_page(html, max_cards=4)
    assert [c["title"] for c in cards] == ["Title 10", "Title 11", "Title 12", "Title 13"]


def test_job_cards_dataframe(spark):
    pages = spark.createDataFrame([(1, page(CARD.format(k=5), CARD.format(k=6))), (2, None), (3, "")],
                                  "page_id long, html string")
    rows = valid_cards(job_cards(pages, scraped_at="2001-01-01T00:00:00")).orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.pos, r.title) for r in rows] == [(1, 1, "Title 5"), (1, 2, "Title 6")]


def test_valid_cards_keeps_null_url(spark):
    df = spark.createDataFrame([("a", None), ("N/A", "u"), ("b", "N/A"), ("c", "u")], "title string, url string")
    assert sorted(r.title for r in valid_cards(df).collect()) == ["a", "c"]


def test_page_triage(spark):
    big = "Just a moment" + "x" * 100001
    rows = [(1, "Verify you are human"), (2, big), (3, "y" * 30000), (4, None), (5, "Checking your browser")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    out = {r.page_id: r for r in page_triage(df).collect()}
    assert {k: r.page_status for k, r in out.items()} == {1: "challenge", 2: "ok", 3: "ok", 4: "ok", 5: "short"}
    assert (out[2].needs_wait, out[5].needs_wait, out[1].needs_wait) == (True, True, False)


def test_entity_encoded_class_still_parsed(spark):
    html = '<div class="&#106;ob"><h3>Title 7</h3><p>' + "x" * 60 + "</p></div>"
    assert "job" not in html
    pages = spark.createDataFrame([(1, html), (2, "<html><p>nothing here</p></html>")], "page_id long, html string")
    rows = job_cards(pages, scraped_at="2001-01-01T00:00:00").collect()
    assert [(r.page_id, r.title) for r in rows] == [(1, "Title 7")]


def test_malformed_and_commented_html():
    html = ('<HTML><!-- <div class="job"><h3>ghost</h3></div> -->'
            '<DIV CLASS="job x"><H3 data-url="">  T  <a href="/rel">A</a></H3>'
            '<div class>' + "y" * 60 + '<p>unclosed')
    (c,) = cards_in_page(html, base_url="https://b")
    # comment ignored, tags case-folded, empty data-url falls back to the link,
    # unclosed elements end at the end of the page
    assert (c["title"], c["url"]) == ("TA", "https://b/rel")


def test_carry_page_columns(spark):
    pages = spark.createDataFrame([(1, page(CARD.format(k=1), CARD.format(k=2)), 7), (2, page(CARD.format(k=3)), 9)],
                                  "page_id long, html string, batch_idx int")
    rows = job_cards(pages, scraped_at="2001-01-01T00:00:00", carry=("batch_idx",)).collect()
    assert sorted((r.page_id, r.pos, r.batch_idx) for r in rows) == [(1, 1, 7), (1, 2, 7), (2, 1, 9)]


def test_broken_markup_costs_no_card():
    """Unknown marked sections, stray declarations and unclosed tags: the rest of the page is parsed."""
    card = CARD.format(k=1)
    for junk in ("<![foo[x]]>", "<![CDATA[x]]>", "<![if IE]>", "<!ELEMENT x>", "<!>", "</>", "<b <i>", "&#xZZ;", "<!--x"):
        cards = cards_in_page(page(card) + junk + ("" if junk == "<!--x" else CARD.format(k=2)))
        assert [c["title"] for c in cards][:1] == ["Title 1"] and all(c["parse_error"] is None for c in cards), junk
        assert len(cards) == (1 if junk in ("<!--x",) else 2), junk


def test_card_behind_named_references_is_found(spark):
    html = page(CARD.format(k=1)).replace('class="ipy-2 job-card"', 'class="x&fjlig;ob-card"').replace(
        "/it-jobs/", "/x/").replace("<div class=job>", "")
    rows = job_cards(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()
    assert "job" not in html and [r["title"] for r in rows] == ["Title 1"]


@pytest.mark.parametrize("markup,cards", [
    ("<div class='job'>" * 100_000 + "<h3>title " + "text " * 20, 40),
    ("<div class='job'>" * 100_000 + "</x>" * 100_000, 0),
    ("<div class='job'><form>" * 50_000 + "<h3>" + "x " * 50, 0)])
def test_deeply_nested_cards_take_linear_time(markup, cards):
    start = time.process_time()
    assert len(cards_in_page(markup)) == cards
    assert time.process_time() - start < 20


FRAGMENTS = ['<div class="job">', '<div class="x jobs">', "</div>", "<div>", '<h3 data-url="/u">', "<H3 DATA-URL='/v'>", "</h3>",
             ' <a href="https://x/1">', "</a>", "<a href='/companies/y'>", "text", "lorem " * 10, "a &amp; b", "&", "<br>", "<br />",
             "<form>", "</form>", '<span class="text-nowrap text-rich-grey x text-truncate">', "</span>", "<div hidden class>",
             '<div data-controller="responsive-tag-list">', '<div class="fw salary">', "<!-- c -->", "<!--x", "<!doctype html>",
             '<script>var t="<div class=job>";</script>', "<script>", "</script>", "<style>a{}</style >", "<title>T &amp; x</title>",
             "<title>a<b>", "<template>", "</template>", "< b", "<a b = 'c'>", "<div class=job id=x>", "<div class=job/>",
             '<div class="job&amp;">', '<div class="a>b job">', "<my-el>", "</my-el>", "<![x]>", '<div class="a" class="job">']


def test_plain_pages_as_the_library_reads_them():
    rng, plain = random.Random(5), 0
    for _ in range(3000):
        html = "".join(rng.choice(FRAGMENTS) for _ in range(rng.randrange(1, 25)))
        page, doc = html_cards._Plain(), html_cards._Doc()
        if not page.read(html):
            continue
        doc.feed(html)
        doc.close()
        for d in (page, doc):
            d.index()
        plain += 1
        assert page.places == doc.places, html
        for at in {at for places in doc.places.values() for at in places}:
            a, b = page.nodes[at], doc.nodes[at]
            assert (a.tag, a.attrs, a.last, page.text(a), page.text(a, strip=True)) == (
                b.tag, b.attrs, b.last, doc.text(b), doc.text(b, strip=True)), html
    assert plain > 500


def test_plain_pages_need_no_library_parser(monkeypatch):
    def feed(self, data):
        raise AssertionError("slow")

    monkeypatch.setattr(html_cards._Doc, "feed", feed)
    (c,) = cards_in_page("<!doctype html><title>a &amp; b</title><script>if (a < b) x('<div class=job>')</script>"
                         + page(CARD.format(k=1)))
    assert c["parse_error"] is None and c["title"]
