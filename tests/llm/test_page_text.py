import html as entities
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from terracat.llm import page_text

SCHEMA = "page_id long, url string, html string"


def plain(page):
    """The driver's pages have one article of h1, p, b and br."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(entities.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", body))).split())


def result(df):
    assert df.columns == ["page_id", "url", "text", "n_chars"] and dict(df.dtypes)["n_chars"] == "bigint"
    rows = df.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return {(r["page_id"], r["url"]): r["text"] for r in rows}


def test_table_equals_article(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = df.collect()
    got = result(page_text.extract(df))
    assert got == {(r["page_id"], r["url"]): plain(r["html"]) for r in rows} and len(got) == len(rows)


def soup(rng, k, say):
    """A page without any telling element, class or id."""
    links = "".join(f"<div class=m><a href=/{k}{j}>{say(1)}</a></div>" for j in range(rng.randint(2, 6)))
    paragraphs = [say(rng.randint(5, 60)) for _ in range(rng.randint(2, 5))]
    title = say(4)
    page = (f"<html><body><div class=x1><div class=x2>{links}</div></div><div class=x3>We keep small files on your device.</div>"
            f"<div class=x4><h1>{title}</h1><div class=x5>" + "".join(f"<p>{p}" for p in paragraphs)
            + f"</div></div><div class=x6>Latest: {say(2)}</div><div class=x7>All rights reserved by the owner {say(1)}</div></body></html>")
    return page, " ".join([title, *paragraphs])


@pytest.mark.parametrize("broadcast", [page_text.BROADCAST_BYTES, -1])
def test_slots_of_pages_without_telling_names(spark, monkeypatch, broadcast):
    monkeypatch.setattr(page_text, "BROADCAST_BYTES", broadcast)
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows, want = [], {}
    for k in range(24):
        page, text = soup(rng, k, say)
        url = f"https://{'one' if k % 2 else 'two'}.example.org:8080/{k}"
        rows.append((k, url, page))
        want[k, url] = text
    assert result(page_text.extract(spark.createDataFrame(rows, SCHEMA).repartition(5))) == want
    template = page_text.templates(spark.createDataFrame(rows, SCHEMA)).orderBy("host").collect()
    assert [r["host"] for r in template] == ["one.example.org", "two.example.org"]


def test_classes_are_ordered_nested_or_left_out():
    found = pd.DataFrame([
        ("order", 0, 0, 7, 7, 10, 0), ("order", 1, 0, 9, 9, 40, 0), ("order", 2, 0, 5, 6, 10, 0), ("order", 3, 0, 8, 8, 80, 0), ("order", 4, 0, 3, 3, 20, 0),
        ("gap", 1, 0, 2, 2, 0, 0), ("gap", 3, 0, 2, 2, 0, 0), ("gap", 3, 1, 1, 1, 0, 0), ("gap", 4, 0, 1, 3, 0, 0), ("gap", 2, 0, 1, 1, 0, 0), ("gap", 1, 3, 0, 0, 0, 0),
        ("words", 101, 100, 0, 0, 2, 28), ("words", 102, 100, 0, 0, 500, 3), ("words", 103, 100, 1, 1, 9, 0)],
        columns=["kind", "a", "b", "low", "high", "n", "m"])
    got = page_text.nest(found, [[1, 2], [3, 4], [5, 6], [7, 8], [9, 10]])
    assert [(p["class"], p["in"], p["gap"]) for p in got["parts"]] == [(0, None, None), (1, 0, 2), (3, 1, 1)]
    assert got["main"] == [102, 103]  # the heading beside the body


def test_dropped_places():
    page = """<!doctype html><html><head><title>T</title><script>if (a < b) document.write("</p><article>no</article>")</script>
      <style>p > a {}</style></head><body class="has-sidebar"><header>Site</header><ul class="main-menu"><li>Home<li>About</ul>
      <div class="cookieNotice">We use cookies</div><main><div id=ad-12>Buy</div>
      <article class="post with-comments"><header><h1>A &amp;&nbsp;B&lt;C</h1></header><p>One<b>two</b> three<br>four
      <p hidden>secret<p>x < y > z<form>Mail <input value="a>b"> <button>Go</button></form><table><tr><td>c1<td>c2</table>
      <aside>More</aside><div role="complementary">Side</div><!-- a <p>comment</p> --><noscript>js</noscript>
      <pre> kept   <a href='x>y'>link</a>ed </pre><article class="comment">First!</article><footer>by me</footer></article>
      <div class="share-this">Share</div></main><aside class=sidebar>Tags</aside><footer>&copy; me</footer></body></html>"""
    assert page_text.main_text(page, None) == "A & B<C Onetwo three four x < y > z c1 c2 kept linked"
    assert page_text.main_text("<p>no article <i>at all<div>here</div><script>x", None) == "no article at all here"
    assert page_text.main_text("a<b", None) == "a<b" and page_text.main_text("", None) == ""


def test_shared_passages_of_articles_stay(spark):
    """Copies and lines that all pages of a host share are main text in an article."""
    rows = [(k, "http://h.org/", f"<nav>Menu</nav><article><h1>Same title</h1><p>{'unlike ' + str(k) if k < 4 else 'copy'}<p>This line is shared.</article>") for k in range(12)]
    got = page_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["page_id"], r["text"]) for r in got} == {(k, f"Same title {'unlike ' + str(k) if k < 4 else 'copy'} This line is shared.") for k in range(12)}


def test_odd_rows(spark):
    assert result(page_text.extract(spark.createDataFrame([], SCHEMA))) == {}
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "<article>plain"), (None, "http://a.b/", "<article>no id</article>"),
            (5, "http://A.B/", "<article>" + "long words " * 100_000 + "</article>"), (6, "http://a.b", "<p>" * 50_000 + "x" + "<b" * 1000),
            (7, "http://a.b", deep), (8, "http://a.b/", "<article><b>" * 3000 + "</p>" * 3000 + "end"), (9, "http://a.b", "<a title=\"" * 20_000), (10, "http://a.b", "&#0;&#xD800;&bogus;&amp")]
    df = spark.createDataFrame(rows + rows[2:5], SCHEMA).withColumn("host", F.lit("clash")).withColumn("text", F.lit(1)).withColumn("template", F.lit("x"))
    out = page_text.extract(df)
    assert out.count() == 13
    got = result(out)
    assert got[1, None] == "" == got[2, ""] and got[3, "not a url"] == "plain" and got[None, "http://a.b/"] == "no id"
    assert got[5, "http://A.B/"] == "long words " * 99_999 + "long words" and got[7, "http://a.b"] == "deep"
    assert got[8, "http://a.b/"] == "end" and got[10, "http://a.b"] == "��&bogus;&"
