"""Extraction, URL rules, byte BPE, packing and licence scans."""

import base64
import hashlib
import time

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirelens.llm import byte_bpe, license_scan, packing, text_density, url_rules
from hirelens.llm.queries import RANK_FILE, URL_RULES

ARTICLE = "<article><h1>Title here</h1><p>First &amp; best&nbsp;words\n of it.</p><p>Second <b>bold</b> block.<br>Next</p></article>"
WANT = "Title here\nFirst & best words of it.\nSecond bold block. Next"
AROUND = ("<nav><ul><li><a href='/a'>Menu</a></li></ul></nav><div class='ad'>Buy this now, it is a very long advert text "
          "that goes on and on.</div>")
AFTER = "<section id='comments'><p>I disagree with all of this, said a reader.</p></section><footer>&copy; x</footer>"


@pytest.mark.parametrize("markup,want", [
    (f"<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body>{AROUND}{ARTICLE}{AFTER}"
     "</body></html>", WANT),
    (f"<body>{AROUND}{ARTICLE.replace('article', 'div')}{AFTER}", WANT),
    (f"<html><head><style>p{{}}</style><body><form><p>Name</p><input></form>{ARTICLE}<aside>Side</aside>", WANT),
    ("<p>Only one paragraph", "Only one paragraph"),
    ("plain text < 5 & more &amp", "plain text < 5 & more &"),
    ("<article><p><b>Unclosed.<br><p>Next one</p><p>cut o", "Unclosed.\nNext one\ncut o"),
    ("<article><p>Seen</p><!-- <p>not</p> --><p>too</p><p cla", "Seen\ntoo"),
    ("<article><![foo[<p>x</p>]]><p title='a > b'>y</p></article>", "x\n]]>\ny"),
    ("<article><p>a</p><script>if (a<b) {}</script><p>b</p><script>never closed <p>c</p>", "a\nb"),
    ("", ""), (None, ""), ("<nav>menu</nav>", ""), ("<html></html>", "")])
def test_main_text(markup, want):
    assert text_density.main_text(markup) == want


LONG = "".join(f"<p>{'word ' * 30}{i}.</p>" for i in range(4))
LONG_WANT = "\n".join("word " * 30 + f"{i}." for i in range(4))


@pytest.mark.parametrize("markup,want", [
    *((f"<body><div {mark}>{AROUND}{ARTICLE}{AFTER}</div></body>", WANT) for mark in (
        "class='page has-sidebar'", "class=layout-with-sidebar", "id='no-banner'", "class='content widget'")),
    *((f"<body>{AROUND}<div {mark}><h1>Title here</h1>{LONG}</div>{AFTER}</body>", "Title here\n" + LONG_WANT) for mark in (
        "class='page has-sidebar'", "class='layout-with-sidebar'", "id='no-banner'")),
    (f"<body><div class='content widget'>{LONG}</div></body>", LONG_WANT),
    (f"<article>{LONG}<section id='search-algorithms'><p>Of searching.</p></section><p class='related-work'>Others.</p>"
     "</article>", LONG_WANT + "\nOf searching.\nOthers."),
    (f"<article>{LONG}<div class='share-buttons'><a href='/a'>Send it</a> <a href='/b'>Post it</a></div>"
     "<div class='ad'>Buy</div></article>", LONG_WANT),
    # Comments stay out, be they articles of their own or longer than the article.
    (f"<body>{ARTICLE}<section class='comments'><article><p>Oh no.</p></article></section></body>", WANT),
    (f"<body>{ARTICLE}<section class='post-comments'>{LONG}{LONG}</section></body>", WANT)])
def test_marks_on_wrappers_and_inside_the_article(markup, want):
    assert text_density.main_text(markup) == want


PARAGRAPHS = "".join(f"<p>{'word ' * 30}{i}.</p>" for i in range(5))
PARAGRAPHS_WANT = "\n".join("word " * 30 + f"{i}." for i in range(5))


@pytest.mark.parametrize("frame", ["<article>%s</article>", "<div class=content>%s</div>"])
@pytest.mark.parametrize("mark", ["ad-box", "user-comments", "cookie-banner", "newsletter-signup", "share-buttons",
                                  "site-notice", "related-posts"])
def test_boxes_marked_by_compounds_go(mark, frame):
    box = f"<div class='{mark}'><p>Take our thing now, or read what others say. It is good.</p></div>"
    for page in (frame % (box + PARAGRAPHS), frame % (PARAGRAPHS + box), frame % PARAGRAPHS + box):
        assert text_density.main_text(f"<body><nav>menu</nav>{page}</body>") == PARAGRAPHS_WANT


def test_comments_longer_than_the_article_go():
    comments = "".join(f"<div><p>{'comment ' * 40}{i}.</p></div>" for i in range(12))
    for page in (f"<div class=content>{PARAGRAPHS}</div><div class='user-comments'>{comments}</div>",
                 f"<article>{PARAGRAPHS}</article><section class=comments><article>{comments}</article></section>"):
        assert text_density.main_text(f"<body>{page}</body>") == PARAGRAPHS_WANT


@pytest.mark.parametrize("part", ["<div>", "<ul><li>x", "<b>", "<p><b>x ", "<table><tr><td>", "<article>",
                                  "<div class='widget'>x", "<div class='ad'>", "<i><p>"])
def test_badly_nested_pages_take_linear_time(part):
    start = time.process_time()
    text_density.main_text(part * 100_000 + "end")
    assert time.process_time() - start < 20


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/pab=\"' !-[]&;divul\n", max_size=120))
def test_any_markup_is_parsed(markup):
    out = text_density.main_text(markup)
    assert "\n\n" not in out and out == out.strip()


def test_density_prefers_text_to_links():
    links = "".join(f"<li><a href='/{i}'>Read more about item number {i}</a></li>" for i in range(30))
    body = "".join(f"<p>{'word ' * 40}{i}.</p>" for i in range(5))
    text = text_density.main_text(f"<body><div><ul>{links}</ul></div><div>{body}</div></body>")
    assert "Read more" not in text and text.count("\n") == 4


def test_extract_rows(spark):
    rows = [(1, "u", ARTICLE), (1, "u", ARTICLE), (None, None, None), (2, "v", "<p>" + "long " * 200_000 + "</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("other"))
    got = {tuple(r) for r in text_density.extract(df).collect()}
    assert (1, "u", WANT, len(WANT)) in got and (None, None, "", 0) in got
    assert (2, "v", ("long " * 200_000).strip(), 999_999) in got and len(got) == 3
    assert text_density.extract(df.limit(0)).count() == 0


def plain_verdict(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3:] if url and at >= 0 else ""
    host = regex.match(r"[^/?#]*", rest)[0]
    path = regex.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), a == "block", h + p, a) for h, p, a in rules
            if host and ("." + host).endswith("." + h) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[4]) if fits else (host, path, None, "allow")


def test_url_rules(spark):
    rules = [*URL_RULES, ("b.example.net", "/en/x", "block"), ("deep.a.b.c.d.e.f.g.org", "/", "block"),
             ("example.net", "/en", "allow")]
    urls = ["http://EXAMPLE.net/en/", "http://example.net/en", "http://example.net/english", "https://a.b.example.net/en/xy?z",
            "http://net", "http://net/", "http://xnet/", "http://.net/", "http://example.com/de/a#b", "x://org/fr/?q",
            "http://o.deep.a.b.c.d.e.f.g.org/fr/", "no scheme example.net/", "://net/", "", None, "http://?net/",
            "http://example.net:80/en/", "http://" + "a." * 500 + "net/" + "x" * 5000, "a://b://net/", "http://net/\n/x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(None, urls[0]), (0, urls[0])],
                               "page_id long, url string").withColumn("host", F.lit(1)).withColumn("rule", F.lit(2))
    got = url_rules.judge_urls(df, url_rules.rule_table(spark, rules)).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        assert tuple(r)[1:] == plain_verdict(urls[r["page_id"] or 0], rules)
    assert url_rules.judge_urls(df.limit(0), url_rules.rule_table(spark, rules)).count() == 0
    none = url_rules.judge_urls(df, url_rules.rule_table(spark, rules).limit(0))
    assert none.where("rule is null and verdict = 'allow'").count() == len(urls) + 2


def test_url_rules_run_without_python(spark):
    df = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    plan = url_rules.judge_urls(df, url_rules.rule_table(spark, URL_RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


PATH = public_tokenizers.path(RANK_FILE)
ENC = byte_bpe.encoding(byte_bpe.read_ranks(PATH), public_tokenizers.PATTERN)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}


def plain_ids(text):
    """Merges by rank, match by match."""
    out = []
    for m in regex.findall(public_tokenizers.PATTERN, text):
        parts = [bytes([b]) for b in m.encode()]
        while len(parts) > 1:
            at = min(range(len(parts) - 1), key=lambda i: RANKS.get(parts[i] + parts[i + 1], 1 << 40))
            if parts[at] + parts[at + 1] not in RANKS:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        out += [RANKS[p] for p in parts]
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1 '\n\t\u00a0é漢😀sre!_-\u0301\x1c", max_size=60), st.integers(1, 9))
def test_pieces_give_the_ids_of_the_whole(text, most):
    want = plain_ids(text)
    assert byte_bpe.encode_text(ENC, text, most) == want == ENC.encode_ordinary(text)
    assert ENC.decode_bytes(want) == text.encode()


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000 + "x", "ab1!" * 60_000, "漢字" * 60_000])
def test_long_runs(text):
    ids = byte_bpe.encode_text(ENC, text)
    assert ids == ENC.encode_ordinary(text) and ENC.decode_bytes(ids) == text.encode()


def test_encode_and_decode(spark):
    rows = [(1, "Hello wörld's <|endoftext|>"), (1, "Hello wörld's <|endoftext|>"), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1))
    whole = byte_bpe.encode(df, PATH, public_tokenizers.PATTERN)
    assert sorted(r["n_tokens"] for r in whole.collect())[:2] == [0, 0]
    back = byte_bpe.decode(whole, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r["bytes"]) for r in back) == sorted((t or "").encode() for _, t in rows)
    got = {tuple(r) for r in byte_bpe.encode(df, PATH, public_tokenizers.PATTERN, digests=True).collect()}
    want = set()
    for i, t in rows:
        ids = plain_ids(t or "")
        want.add((i, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want
    assert byte_bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def plain_best_fit(sizes, caps, opening):
    bins = []  # [room, contents]
    for n in sizes:
        fits = [b for b in bins if b[0] >= n]
        if fits:
            b = min(fits, key=lambda b: b[0])
        else:
            b = [opening if n <= opening else min(c for c in caps if c >= n), 0]
            bins.append(b)
        b[0] -= n
        b[1] += n
    return sorted(b[1] for b in bins)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60), st.sampled_from([8, 24, 64]))
def test_best_fit_equals_the_plain_one(sizes, opening):
    sizes = sorted(sizes, reverse=True)
    bins, offsets, used = packing.best_fit(np.asarray(sizes, np.int64), [8, 24, 64], opening)
    assert sorted(used) == plain_best_fit(sizes, [8, 24, 64], opening)
    seen = {}
    for n, b, o in zip(sizes, bins.tolist(), offsets.tolist()):
        assert o == seen.get(b, 0)
        seen[b] = o + n


def least_cost(sizes, caps, overhead):
    """The optimum over all ways to put the pieces into bins, by trying them."""
    def put(i, bins):
        if i == len(sizes):
            return sum(min(c for c in caps if c >= b) + overhead for b in bins)
        tried = [put(i + 1, bins[:j] + [b + sizes[i]] + bins[j + 1:]) for j, b in enumerate(bins)
                 if b + sizes[i] <= max(caps)]
        return min([*tried, put(i + 1, [*bins, sizes[i]])])
    return put(0, [])


def test_pack_group_costs_little_more_than_the_optimum():
    rng, caps, got, best = np.random.default_rng(5), [8, 24, 64], 0, 0
    for _ in range(60):
        sizes = sorted(rng.integers(1, 65, 6).tolist(), reverse=True)
        bins, _, final, _ = packing.pack_group(np.asarray(sizes), caps, 2.0)
        cost = sum(dict(zip(bins.tolist(), final.tolist())).values()) + 2.0 * len(set(bins.tolist()))
        optimum = least_cost(sizes, caps, 2.0)
        assert cost >= optimum
        got, best = got + cost, best + optimum
    assert got <= 1.01 * best


def test_pack_without_usable_lengths(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -4), (4, 0)], "doc_id long, n int")
    got = {r["doc_id"]: (r["n_words"], r["bin_capacity"])
           for r in packing.pack(df, length=F.col("n"), capacities=(8,)).collect()}
    assert got == {1: (5, 8), 2: (0, None), 3: (0, None), 4: (0, None)}


def test_pack(spark):
    rng = np.random.default_rng(1)
    rows = [(i % 50 if i % 9 else None, "w " * int(n)) for i, n in enumerate(rng.integers(0, 300, 200))] + [(1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("piece", F.lit("x")).repartition(3)
    caps = (16, 64, 100)
    got = packing.pack(df, capacities=caps, group_rows=80).collect()
    assert sum(r["n_words"] for r in got) == sum((t or "").split().__len__() for _, t in rows)
    assert sum(r["piece"] == 0 for r in got) == len(rows)
    bins = {}
    for r in got:
        if r["n_words"]:
            bins.setdefault(r["bin_id"], []).append(r)
        else:
            assert r["bin_id"] is None and r["bin_capacity"] is None
    for rs in bins.values():
        used = sum(r["n_words"] for r in rs)
        assert {(r["bin_used"], r["bin_capacity"]) for r in rs} == {(used, min(c for c in caps if c >= used))}
        spans = sorted((r["bin_offset"], r["bin_offset"] + r["n_words"]) for r in rs)
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    filled = sum(r["n_words"] for r in got) / sum(rs[0]["bin_capacity"] for rs in bins.values())
    assert filled > 0.95
    assert packing.pack(df.limit(0)).count() == 0
    # The same input gives the same bins again.
    assert sorted(map(str, packing.pack(df, capacities=caps).collect())) == sorted(
        map(str, packing.pack(df, capacities=caps).collect()))


def plain_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(label, i) for phrase, label in license_scan.BASE for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for _, i in places]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for x, _ in places})))


TEXTS = ["Licensed under CC BY-NC 4.0.", "cc by cc by mit license mit license", "the MIT-License; Apache/License",
         "GNU General Public License gnu general public", "ccby cc\u00a0by", "cc\x00by", "", None, "É cc by",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
         "documentation files (the Software), to deal in the Software without restriction", "all rights reserved " * 3,
         "licensed under the apache license version 2 0 you may not use this file"]


def test_license_scan(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0]), (0, TEXTS[0]), (99, "x y mit license " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("labels", F.lit(0))
    got = license_scan.scan(df).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        text = texts[r["doc_id"]] if r["doc_id"] is not None else TEXTS[0]
        assert tuple(r)[1:6] == plain_base(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")
    by = {r["doc_id"]: r for r in got}
    assert by[0]["labels"] == "cc-by,cc-by-nc" and by[9]["labels"] == "mit" and by[9]["n_base"] == 0
    assert by[10]["labels"] == "all-rights-reserved" and len(by[10]["findings"]) == 3
    assert license_scan.scan(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("cc by nc mit license apache gnu general public x the".split()), max_size=40))
def test_base_places_equal_a_plain_search(words):
    text = " ".join(words)
    places, _ = license_scan.Scanner().scan(license_scan.words_of(text.encode()))
    n = plain_base(text)
    assert (len(places), min((s for _, s in places), default=None)) == n[1:3]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=8), min_size=1, max_size=4),
       st.lists(st.integers(0, 4), max_size=25))
def test_matching_statistics(templates, text):
    stats = license_scan.Automaton(templates).statistics(text)
    subs = {tuple(t[a:b]) for t in templates for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    for i, (_, n) in enumerate(stats):
        assert n == max((m for m in range(i + 2) if m == 0 or tuple(text[i + 1 - m:i + 1]) in subs))


def test_chains_of_a_label_and_share_are_disjoint():
    rng = np.random.default_rng(11)
    scanner = license_scan.Scanner()
    pool = [w for t, _ in license_scan.TEMPLATES for w in t.split()] + ["all", "rights", "reserved"] * 30
    for _ in range(60):
        words = [w.encode() for w in rng.choice(pool, 120)] + b"all rights reserved all rights reserved".split()
        _, found = scanner.scan(words)
        spans = {}
        for label, start, end, share in found:
            spans.setdefault((label, share), []).append((start, end))
        assert found and all(a[1] <= b[0] for s in spans.values() for a, b in zip(sorted(s), sorted(s)[1:]))


def test_a_template_repeated_without_end_takes_linear_time():
    scanner, start = license_scan.Scanner(), time.process_time()
    places, found = scanner.scan(b"all rights reserved".split() * 100_000)
    assert len(found) == 100_000 and not places
    assert time.process_time() - start < 20
