"""Main text of pages, and the dated URL list."""

import html
import re

from menulake.llm.common import table
from menulake.llm.extract_text import extract_text, main_text
from menulake.llm.queries import QUERIES
from menulake.llm.url_list import intervals, judge

SF = "/root/testdata/sf0.01"
LONG = "A paragraph that is long enough to make the window sums surge, with a good many words in it."


def test_articles_of_the_table(spark):
    got = {r.page_id: r for r in QUERIES["op10_extract_text"](spark, SF).collect()}
    for p in table(spark, SF, "pages").collect():
        body = re.search(r"<article>(.*)</article>", p.html, re.S).group(1)
        want = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        want = "\n".join(x for x in want if x)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want) and got[p.page_id].url == p.url


def test_surge_and_dive_without_marked_regions():
    page = (f"<html><body><div class=menu><a href=x>Home</a> <a href=y>News</a></div><div id=content><h1>Title</h1><p>{LONG}</p><p>Ok.</p><p>{LONG}</p></div>"
            f"<div class='user comments'><p>{LONG}</p></div><div class=cookie-notice>{LONG}</div><footer>{LONG}</footer></body></html>")
    assert main_text(page) == f"Title\n{LONG}\nOk.\n{LONG}"


def test_inside_an_article():
    page = f"<main><header><h1>T</h1></header><p>a&nbsp;&lt;b&gt; c<br>d {LONG}</p><aside>x</aside><form>f</form><p>e<script>var x='<p>';</script>f</p></main>"
    assert main_text(page) == f"T\na <b> c d {LONG}\nef"


def test_odd_pages():
    assert main_text("") == main_text(None) == ""
    assert main_text("<p>a") == "a" and main_text("plain &amp text") == "plain & text"
    assert main_text("<div><p>" * 5000 + "deep") == "deep"
    assert main_text("<b>" * 20_000 + "x" + "</i>" * 20_000) == "x"
    assert main_text("<!-- open <p>x") == "" and main_text("<script>never closed <p>x") == ""


def test_page_rows(spark):
    p = spark.createDataFrame([(1, "u", None, 1), (None, None, f"<article><p>{LONG}</p></article>", 2), (1, "u", "", 3), (1, "u", "", 3)], "page_id long, url string, html string, n_chars int")
    r = sorted(map(tuple, extract_text(p).collect()), key=str)
    assert r == sorted([(1, "u", "", 0)] * 3 + [(None, None, LONG, len(LONG))], key=str)
    assert extract_text(p.limit(0)).count() == 0


def test_intervals(spark):
    e = spark.createDataFrame([("A.com", "block", "2024-01-01"), ("a.com", "drop", "2024-02-01"), ("a.com", "block", "2024-03-01"), ("a.com", "block", "2024-03-01"),
                               ("b.com", "allow", "2024-01-01"), ("b.com", "block", "2024-01-01"), (None, "block", "2024-01-01"), ("c.com", "block", None), ("d.com", "other", "2024-01-01")],
                              "pattern string, action string, at string")
    got = sorted((r.pattern, r.action, str(r.valid_from)[:10], str(r.valid_to)[:10]) for r in intervals(e).collect())
    assert got == [("a.com", "block", "2024-01-01", "2024-02-01"), ("a.com", "block", "2024-03-01", "9999-12-31"), ("b.com", "block", "2024-01-01", "9999-12-31")]


def test_judged_as_of_the_fetch(spark):
    e = spark.createDataFrame([("a.com", "block", "2024-02-01"), ("a.com", "drop", "2024-06-01"), ("x.a.com/ok", "allow", "2024-01-01")], "pattern string, action string, at string")
    rows = [(1, "http://a.com/p", "2024-01-31"), (2, "http://A.com:80/p", "2024-02-01"), (3, "http://a.com/p", "2024-05-31"), (4, "http://a.com/p", "2024-06-01"), (5, "https://u@x.a.com/ok/p?q", "2024-03-01"),
            (6, "http://x.a.com/okay", "2024-03-01"), (7, "http://ba.com", "2024-03-01"), (8, None, "2024-03-01"), (9, "nonsense", "2024-03-01"), (10, "http://a.com", None), (2, "http://A.com:80/p", "2024-02-01"), (None, "http://a.com", "2024-03-01")]
    c = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, fetched_at string, pattern string")
    got = judge(c, e).collect()
    assert len(got) == len(rows)
    assert sorted((r.page_id for r in got if r.blocked), key=str) == sorted([2, 2, 3, 6, None], key=str)
    assert {r.page_id: r.pattern for r in got}[5] == "x.a.com/ok"
    assert judge(c.limit(0), e).count() == 0 and not any(r.blocked for r in judge(c, e.limit(0)).collect())
