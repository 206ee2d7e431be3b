"""The operators on pages against their rules in plain Python."""

from __future__ import annotations

import re
import time
from collections import Counter
from html import unescape

import pytest
from pyspark.sql import functions as F

from sievemart.llm import html_text, url_rules, warc_fixity

SF = "/root/testdata/sf0.01"
CLASHING = ["_id", "_url", "host", "path", "verdict", "text", "archive", "record", "offset", "id"]

URLS = [
    None,
    "",
    "no separator example.net/",
    "http://",
    "https://EXAMPLE.Net/en/1?q=/fr/#x",
    "https://a.b.example.net/de/2",
    "http://example.com/de",
    "http://www.example.com/de/x://y/",
    "http://notexample.com/de/",
    "http://x.org/fr/",
    "http://org/fr/deep/path",
    "http://x.org?/fr/",
    "http://net/",
    "http://user@net:80/",
    "http://net.",
    "HTTP://ÄX.NET/",
    "x" * 5000 + "://" + "a." * 3000 + "net/" + "p" * 5000,
]


def pages(spark, rows):
    schema = "page_id long, url string, html string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *[None] * len(CLASHING)) for r in rows], schema)


def judged(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [
        (len(h + p), v == "block", h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fit, default=(0, 0, None, default))
    return (host, path, best[2], best[3])


@pytest.mark.parametrize(
    "rules",
    [
        list(url_rules.RULES),
        [("block", "b.example.net", ""), ("allow", "example.net", "/de/2"), ("block", "", "/en"), ("block", "x.org", "/fr"), ("allow", "x.org", "/fr")],
        [],
    ],
)
def test_url_rules(spark, rules):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(5, URLS[5], None), (None, URLS[4], None)]
    table = spark.createDataFrame(rules, url_rules.RULE_SCHEMA)
    found = url_rules.judge_urls(pages(spark, rows), table).collect()
    assert Counter(tuple(r) for r in found) == Counter((i, *judged(u, rules)) for i, u, _ in rows)
    assert url_rules.judge_urls(pages(spark, []), table).count() == 0


def article_text(html):
    inner = re.search(r"<article>(.*)</article>", html, re.DOTALL).group(1)
    blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_main_text_of_all_pages(spark):
    given = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r["page_id"]: r for r in html_text.extract_text(given).collect()}
    for page in given.collect():
        assert found[page["page_id"]]["text"] == article_text(page["html"])
        assert found[page["page_id"]]["n_chars"] == len(found[page["page_id"]]["text"])


def test_main_text_without_the_articles_own_mark(spark):
    """Weights come from half of the pages; the others lose their ``article`` tags."""
    given = spark.read.parquet(f"{SF}/pages.parquet").collect()
    weights = html_text.learn_weights(spark.createDataFrame(given[::2]))
    for page in given[1::2]:
        bare = re.sub(r"</?article>", "", page["html"])
        assert html_text.main_text(bare, dict(weights)) == article_text(page["html"])


def test_main_text_leaves_out_what_is_not_the_article():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <header><p>Site name and slogan</p></header><div class="cookie-notice"><p>We use cookies here</p></div>
    <nav><ul><li><a href=x>Home</a></ul></nav><main><article><header><h1>The  title</h1></header>
    <p>First &lt;b&gt; para&shy;graph with <b>bo</b>ld&nbsp;and <a href='x>y'>a link</a>.<p>Second<br>line
    <script>var x = "</p><p>not this</p>";</script><aside>Read this too</aside>
    <div class="ad"><div>Buy</div> now</div><ul><li>item one</li><li>item two</li></ul>
    <form><label>Mail</label><input><button>Send</button></form><!-- hidden -->
    <p>Third</p></article><section id="comments"><p>A reader says things</p></section></main>
    <aside class="sidebar"><p>More articles</p></aside><footer><p>Imprint</p></footer></body></html>"""
    text = html_text.main_text(html, {})
    assert text == (
        "The title\nFirst <b> para\xadgraph with bold and a link.\nSecond line\nitem one\nitem two\nThird"
    )


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain text only", "plain text only"),
        ("<p>open <b>never closed", "open never closed"),
        ("<script>never closed <p>x</p>", ""),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
        ("<p>x</p><!-- never closed <p>y</p>", "x"),
        ("</p></div><p>stray</p></section>", "stray"),
        ("<p>" + "long " * 50_000 + "</p>", ("long " * 50_000).strip()),
        ("<nav>only a menu</nav>", ""),
        ("<div>" * 3000 + "<p>deep</p>", "deep"),
    ],
)
def test_broken_and_odd_pages(html, text):
    assert html_text.main_text(html, {}) == text


def test_html_nulls_repeats_and_empty(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>x</p>"), (2, "u", "")]
    found = html_text.extract_text(pages(spark, rows)).collect()
    assert Counter(tuple(r) for r in found) == Counter(
        [(1, None, "", 0), (1, None, "", 0), (None, "u", "x", 1), (2, "u", "", 0)]
    )
    assert html_text.extract_text(pages(spark, [])).count() == 0


def test_best_stretch_is_the_brute_force_one():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(200):
        scores = rng.integers(-4, 5, rng.integers(1, 25)).astype(float).tolist()
        start, end = html_text.best_stretch(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)]
        assert sum(scores[start:end]) == max(0.0, *sums)


BROKEN = (
    ["<svg", "<!-x<title ", '<a "', "<a 'x\"", '<div a="', "<svg a='", "<1", "<title>", "</title  ", "<!--"]
    + ["<div>", "</b></i>", "<svg>", "<template \"'", "<p a='<svg \""]
)


def test_broken_pages_take_linear_time():
    # 300 KB each; a scan back to an earlier place for every tag would take minutes.
    for part in BROKEN:
        for tail in ("", ">", '">', "</p>" * 20_000):
            started = time.perf_counter()
            html_text.main_text(part * (300_000 // len(part)) + tail, {})
            assert time.perf_counter() - started < 10, (part, tail[:4])


def test_quotes_that_stay_open():
    text = lambda html: html_text.main_text(html, {})
    assert text('<p a="x>y">one</p>') == "one"
    assert text('<p a="x>one two</p><p>three</p>') == "one two\nthree"
    assert text("<p>a < b and <!-- no end") == "a < b and"
    assert text("<p>a <b no end <!-- no end") == "a <b no end"
    assert text("<p>one</p></div></p><p>two</p>") == "one\ntwo"


def test_warc_records_restore_pages(spark):
    given = spark.read.parquet(f"{SF}/pages.parquet")
    records = warc_fixity.warc_records(given).collect()
    html = {r["page_id"]: r["html"] for r in given.collect()}
    at = {}
    for r in sorted(records, key=lambda r: (r["archive"], r["offset"])):
        assert r["offset"] == at.get(r["archive"], 0)
        at[r["archive"]] = r["offset"] + len(r["record"])
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        assert body == html[r["page_id"]].encode() + b"\r\n\r\n"
        assert f"Content-Length: {len(body) - 4}".encode() in head


def test_audit_finds_every_planted_fault(spark):
    rows = [(f"a{i % 7}", i // 7 * 5000, bytes([i % 251]) * (i % 90)) for i in range(4000)]
    rows += [("a1", 7, None), (None, 3, b"x"), ("a2", None, b"y"), ("a3", 10, b"s"), ("a3", 10, b"t")]
    rows += [("big", n << 33, b"z") for n in range(5)]
    schema = "archive string, offset long, record binary, length long, digest string, node int"
    frame = lambda x: spark.createDataFrame([(*r, None, None, None) for r in x], schema)
    other, expected = [], set()
    for n, (archive, offset, record) in enumerate(rows):
        fault = {5: "changed", 6: "missing", 7: "null"}.get(n % 173)
        if n == 4003:
            fault = "changed"
        if fault == "missing":
            expected.add((archive, offset, "missing"))
            continue
        if fault in ("changed", "null"):
            expected.add((archive, offset, "changed"))
            record = (record or b"") + b"!" if fault == "changed" else None if record is not None else b""
        other.append((archive, offset, record))
    other.append(("new", 5, b"more"))
    expected.add(("new", 5, "extra"))
    found = warc_fixity.merkle_audit(frame(rows), frame(other)).collect()
    assert {(r["archive"], r["offset"], r["kind"]) for r in found} == expected
    assert len(found) == len(expected)
    assert warc_fixity.merkle_audit(frame(rows), frame(rows[::-1])).count() == 0
    assert warc_fixity.merkle_audit(frame([]), frame([])).count() == 0
    assert warc_fixity.merkle_audit(frame(rows[:9]), frame([])).count() == 9


def test_audit_of_records_without_a_place_and_of_copies(spark):
    schema = "archive string, offset long, record binary"
    frame = lambda x: spark.createDataFrame(x, schema)
    rows = [(None, None, b"n%d" % (i % 700)) for i in range(2000)]
    rows += [("a", None, b"o%d" % i) for i in range(500)] + [("a", 0, b"same place %d" % (i % 90)) for i in range(900)]
    rows += [("a", 70_000 + i, None) for i in range(3)] + [("b", 5, b"c")] * 4
    other = [r for n, r in enumerate(rows) if n not in (3, 2007, 2600)]
    other += [(None, None, b"new"), ("b", 5, b"c"), ("b", 5, b"d"), ("b", 5, b"c"), (None, 7, b"m")]
    lost, found = Counter(rows) - Counter(other), Counter(other) - Counter(rows)
    per_place = lambda c: Counter({p: sum(n for r, n in c.items() if r[:2] == p) for p in {r[:2] for r in c}})
    too_few, too_many = per_place(lost), per_place(found)
    expected = Counter()
    for side, kind in ((lost, "missing"), (found, "extra")):
        for (archive, offset, _), n in side.items():
            changed = too_few[archive, offset] == too_many[archive, offset] == 1
            expected[archive, offset, "changed" if changed else kind] += n if not changed else side is lost
    audit = warc_fixity.merkle_audit(frame(rows), frame(other)).collect()
    told = Counter()
    for r in audit:
        told[r["archive"], r["offset"], r["kind"]] += r["copies"]
    assert told == +expected
    leaves = warc_fixity.merkle_tree(warc_fixity.record_digests(frame(rows), "archive", "offset", "record"))
    unknown = leaves.filter("level = 0 AND archive IS NULL").count()
    assert unknown > 600  # not one leaf for all


def test_warc_records_of_awkward_pages(spark):
    rows = [(None, None, None), (1, "a\r\nb", "é"), (1, "a\r\nb", "é")]
    records = warc_fixity.warc_records(pages(spark, rows).drop("id")).collect()
    assert len(records) == 3
    assert sum(b"Target-URI: a b\r\n" in bytes(r["record"]) for r in records) == 2
    assert warc_fixity.warc_records(pages(spark, [])).count() == 0


def test_tree_levels_have_one_root_per_archive(spark):
    rows = [(f"a{i % 3}", i * 70_000, b"r%d" % i) for i in range(300)]
    digests = warc_fixity.record_digests(
        spark.createDataFrame(rows, "archive string, offset long, record binary"), "archive", "offset", "record"
    )
    counts = {
        r["level"]: r["n"]
        for r in warc_fixity.merkle_tree(digests).groupBy("level").agg(F.count("*").alias("n")).collect()
    }
    assert counts[warc_fixity.LEVELS - 1] == 3
    assert counts[0] > counts[1] > counts[2]
