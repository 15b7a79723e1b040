"""HTML extraction: pages built from known parts, and a brute-force reading of the given pages."""

import html
import random
import re
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from civicspark.llm import html_extract as H
from civicspark.llm import queries
from civicspark.llm.page_blocks import read_page
from tests.conftest import SF_SMALL

SCHEMA = "page_id bigint, url string, html string, host string, path string, paths string, text int, n int"


def _frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "h", "p", None, 1, 2) for r in rows], SCHEMA).repartition(partitions)


def _sentence(rnd, n):
    return " ".join(rnd.choice(["alpha", "böta", "gamma &amp; co", "d&eacute;lta", "x &lt; y", "zeta,"]) for _ in range(n)).capitalize() + "."


def _plain(markup):
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", markup)).split())


MENU = "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>About us</a><li><a href='/c'>All the news</a></ul></nav>"
TEMPLATES = {
    "article": "<body><header><h1>The Site</h1>{menu}</header><article>{body}</article><aside>{noise}</aside><footer>{noise}</footer>",
    "division": "<body class='page with-sidebar'><div id=top>{menu}</div><div class='row-{n}'><div class='col content'>{body}</div><div class='col sideBar'>{noise}</div></div><div class=footer>{noise}</div></body></html>",
    "form": "<body><form action=x><input name=q><div id='main'><div class='post post-{n}'>{body}</div><section id=comments><h2>Said</h2><article class=comment>{noise}</article></section></div></form>",
    "cells": "<body><table><tr><td class=left><div class=menu>{menu}</div><td class=centre>{body}<td class=right><div class='ad-box'>{noise}</div></table>",
    "main": "<body><div role=banner>{noise}</div><main><header>{body}</header><div class=cookieNotice>{noise}</div><div class=related><a href=1>{noise}</a></div></main><div role=contentinfo>{noise}</div>",
    "inner": "<body><div class=wrap><article class='post has-sidebar'><div class=entry>{body}</div><div class='share-links'><a href=1>Tell all</a></div><div class=comments>{noise}</div></article></div>",
}


def _page(rnd, template, n):
    inner = [_sentence(rnd, rnd.randrange(4, 30)) for _ in range(rnd.randrange(2, 8))]
    marked = [f"<h2>{inner[0]}</h2>"] + [f"<p>{t}" + rnd.choice(["</p>", "\n", ""]) for t in inner[1:]]
    marked.insert(1, "<!-- <p>hidden</p> --><script>if (a < b) document.write('<p>no</p>')</script><style>p > b {}</style>")
    marked.append("<p>Two <b>bold</b><br>\n lines &nbsp; <a href=x>linked</a>.<ul><li>one <i>item<li>two</ul>")
    noise = f"<p>{_sentence(rnd, 40)}</p>"
    page = TEMPLATES[template].format(menu=MENU, body="".join(marked), noise=noise, n=n)
    text = [_plain(t) for t in inner] + ["Two bold lines linked.", "one item", "two"]
    return f"<!DOCTYPE html><html><head><title>T</title></head>{page}", "\n".join(text)


@pytest.mark.parametrize("template", TEMPLATES)
def test_each_template(template):
    rnd = random.Random(template)
    for n in range(25):
        page, text = _page(rnd, template, n)
        assert H.main_text(page) == text, (template, n)


@pytest.mark.parametrize(
    "around",
    [
        "<div class=topNav>x</div>", "<div class='siteheader'>The Site</div>", "<div id=disqus_thread><p>No!</p></div>", "<div class=cookiebar>We use cookies</div>",
        "<section><h2>12 Comments</h2><p>First! A long remark of a reader, who has read it all.</p></section>", "<div><h3>Kommentare (3)</h3><p>Nein.</p></div>",
        "<div><h4>Related articles</h4><p>Another one</p></div>", "<div hidden>unseen</div>", "<div style='display: none'>unseen</div>", "<ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>",
        "<form action=x>Your mail <input><button>Send</button></form>", "<div role=alert>Old browser</div>", "<div class='wp-newsletter-box'>Subscribe</div>", "<noscript>Turn it on</noscript>", "<aside><p>Aside.</p></aside>",
    ],
)
def test_what_stands_around_is_left_out(around):
    body = "<h1>Comments on the law</h1><p>The first paragraph has some words.</p>{}<p>The second has some more of them.</p><div><h2>History</h2><p>It began.</p></div>"
    text = "Comments on the law\nThe first paragraph has some words.\nThe second has some more of them.\nHistory\nIt began."
    for shell in ("<article>{}</article>", "<div class=post>{}</div>", "<main>{}</main>"):
        assert H.main_text(shell.format(body.format(around))) == text
        assert H.main_text(around + shell.format(body.format("")) + around) == text


@pytest.mark.parametrize("name", ["article-header", "postHeader", "entry_content", "has-sidebar main", "textbody", "note", "shadow", "lead adapted", "loading"])
def test_names_that_mean_no_harm(name):
    page = f"<article><div class='{name}'><h1>Title</h1><p>Lead of the story.</p></div><p>And then the rest of it, at some length.</p></article>"
    assert H.main_text(page) == "Title\nLead of the story.\nAnd then the rest of it, at some length."


def test_hosts_vote(spark):
    rnd, rows, want = random.Random(5), [], {}
    for h, template in enumerate(TEMPLATES):
        for n in range(12):
            page, text = _page(rnd, template, n)
            want[len(rows)] = text
            rows.append((len(rows), f"https://H{h}.example.com/{n}", page))
    # A short article beside a long text that nothing names: alone the page takes the wrong one, its host corrects it.
    shell = "<div class=x{n}><div class=story-of>{a}</div></div><div class=y>{b}</div>"
    for n in range(12):
        a, b = (f"<p>{_sentence(rnd, 60)}</p>", "<p>Short.</p>") if n else ("<p>Brief text.</p>", f"<p>{_sentence(rnd, 90)}</p>")
        page = shell.format(n=n, a=a, b=b)
        want[len(rows)] = _plain(a)
        rows.append((len(rows), f"http://voted.example.org/{n}?a=b", page))
        if n == 0:
            assert H.main_text(page) == _plain(b)
    df = _frame(spark, rows)
    got = {r["page_id"]: r for r in H.extract_main_text(df).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == rows[i][1] for i, r in got.items())
    spark.conf.set("civicspark.htmlBroadcastHosts", "0")
    spark.conf.set("civicspark.hotSlots", "8")
    try:
        assert {r["page_id"]: r["text"] for r in H.extract_main_text(df).collect()} == want
    finally:
        spark.conf.unset("civicspark.htmlBroadcastHosts")
        spark.conf.unset("civicspark.hotSlots")


def test_votes_are_counted_per_host(spark):
    rows = [(f"h{i % 3}", f"<body><div class=c{'x' if i < 20 else i}><p>{'word ' * 20}</p></div>") for i in range(30)] + [("", "<p>no host</p>"), ("e", ""), ("f", "<p>short</p>")]
    got = {r["host"]: r["paths"] for r in H.host_paths(spark.createDataFrame(rows, "host string, html string"), share=0.3).collect()}
    assert got == {"h0": ["body>div.cx", "body>div.c#"], "h1": ["body>div.cx", "body>div.c#"], "h2": ["body>div.cx", "body>div.c#"], "f": [""]}


def test_odd_rows(spark):
    page, text = _page(random.Random(1), "article", 1)
    rows = [(1, "http://a.example/x", page)] * 3 + [(None, None, page), (2, None, None), (3, "no host", ""), (4, "http://a.example/", "just text\n here"), (5, "http://b.example", "<p>\xa0</p>")]
    rows += [(6, "http://c.example", "<div>" * 3000 + "deep"), (7, "http://c.example", "x" * 300_000 + " <b>" * 1000), (8, "http://d.example", "<article><p>cut of"), (9, "http://e.example", "<a href=1>only a link</a>")]
    got = sorted(((r["page_id"], r["text"]) for r in H.extract_main_text(_frame(spark, rows)).collect()), key=repr)
    want = [(1, text)] * 3 + [(None, text), (2, ""), (3, ""), (4, "just text here"), (5, ""), (6, "deep"), (7, "x" * 300_000), (8, "cut of"), (9, "only a link")]
    assert got == sorted(want, key=repr)
    empty = H.extract_main_text(_frame(spark, rows).limit(0))
    assert empty.columns == ["page_id", "url", "text", "n_chars"] and empty.count() == 0


@pytest.mark.parametrize(
    ("markup", "blocks"),
    [
        ("a < b <3 &lt; &copy &#233;&#x41;&nbsp;.", ["a < b <3 < © éA ."]),
        ("<p>one<p>two</div>three<div>four</p>five", ["one", "twothree", "four", "five"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
        ("<ul><li>a<ul><li>b</ul>c<li>d</ul>", ["a", "b", "c", "d"]),
        ("<textarea><p>x</textarea><title>t</title>y<!-- > --><!--->z", ["yz"]),
        ("<p title='a > b' x=\">\">in <B>bo</b>ld</P>", ["in bold"]),
        ("<script>var a = '</p>'; <!-- </SCRIPT>after<?php x ?><![CDATA[y]]> z", ["after z"]),
        ("<span class='visually ad'>x</span>kept<button>no</button>", ["kept"]),
        ("line one<br>line\r\n\ttwo<hr>three", ["line one line two", "three"]),
        ("<dl><dt>a<dd>b<dt>c</dl><h1>x<h2>y</h2>", ["a", "b", "c", "x", "y"]),
    ],
)
def test_blocks(markup, blocks):
    assert [b[1] for b in read_page(markup).blocks] == blocks


@pytest.mark.parametrize("piece", ["<div>", "<b>", "</u>", "<p a=\"", "<!--", "<", "<a b=c ", "<p =", "<li>", "<table><td>", "&", "<a x", "<script>", "</p>"])
def test_reading_takes_time_in_proportion(piece):
    took = []
    for size in (100_000, 400_000):
        t = time.perf_counter()
        H.main_text("<u>" + piece * (size // len(piece)))
        took.append(time.perf_counter() - t)
    assert took[1] < 1.0 + 8 * took[0]


def test_given_pages_by_brute_force(spark):
    def brute(page):
        inside = re.search("<article>(.*?)</article>", page, re.S)[1]
        parts = re.split("</?(?:p|h1)>", inside.replace("<br>", " "))
        return "\n".join(t for t in map(_plain, parts) if t)

    pages = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    got = {r["page_id"]: r["text"] for r in queries.op13_html_extract(spark, SF_SMALL).collect()}
    assert got == {p["page_id"]: brute(p["html"]) for p in pages}
    assert queries.op13_html_extract(spark, SF_SMALL).where(F.col("n_chars") != F.length("text")).count() == 0
