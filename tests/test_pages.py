from datetime import datetime

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import pages as P
from broadsheet.sources import sites


def column(spark, html, expr):
    return spark.createDataFrame([(html, "http://h.org/x?y")], "html string, url string").select(expr).first()[0]


def test_plain_page_fields(spark):
    html = (
        "<html><title>T</title><h1> </h1><nav><a class='x' href=\"/a\">a</a><a class=\"ad_wrap\" href=\"/ad\">ad</a>"
        '<a href="http://o.org/b">b</a><a href="mailto:c">c</a></nav><ARTICLE id="1"><script>if (a<b) {}</script>'
        '<p>A &amp;lt; B&amp</p><!-- <b>no</b> --><div class="ad">buy</div> end </ARTICLE>'
    )
    h, url = F.col("html"), F.col("url")
    assert column(spark, html, P.page_title(h)) == "T"
    assert column(spark, html, P.page_content(h)) == "A &lt; B& end"
    assert column(spark, html, P.page_press(h, F.lit("default"))) == "default"
    assert column(spark, html, P.page_links(html=h, url=url)) == ["http://h.org/a", "http://o.org/b"]
    assert column(spark, html, P.page_links(h, url, cap=1)) == ["http://h.org/a"]
    assert column(spark, "<p>none", P.page_content(h)) is None


def test_site_article_with_nested_blocks():
    html = """<h3 class="news_ttl">third</h3><h2 class="a news_ttl">second</h2>
      <dl class="registration"><dt>in</dt><dd> 2024-03-04 05:06:07 </dd></dl>
      <div class="news_cnt_detail_wrap"> one <div>two<br>three</div><div class="reporter_area">x<div>y</div></div>
      <style>p{}</style> four</div><div>after</div>"""
    read = sites.read_article(html, sites.SITES["mk"])
    assert read["title"] == "second" and read["date_text"] == "2024-03-04 05:06:07"
    assert read["content"].split() == ["one", "twothree", "four"]
    assert sites.read_article(html, sites.SITES["mk_popular"])["title"] == "second"
    assert sites.read_article(html, sites.SITES["hankyung"])["content"] is None


def test_press_and_date_from_attributes(spark):
    html = """<div class="media_end_head_top"><a href="#"><img title="Daily" src="x"></a></div>
      <span class="_ARTICLE_DATE_TIME" data-date-time="2024-03-04 05:06:07">4 March</span>
      <h2 id="title_area">T</h2><div id="newsct_article">C<iframe>f</iframe></div>"""
    pages = spark.createDataFrame([("u1", html), ("u2", "<p>"), ("u3", None)], "url string, html string")
    rows = sites.extract_articles(pages, sites.SITES["naver"], "2024-04-01 00:00:00").collect()
    assert [r.asDict() for r in rows] == [
        {"url": "u1", "title": "T", "content": "C", "press": "Daily", "published_at": datetime(2024, 3, 4, 5, 6, 7)}
    ]


@pytest.mark.parametrize(
    "site, html, links",
    [
        (
            "mk",
            '<li class="news_node ad_wrap"><a class="news_item" href="/ad"></a></li>'
            '<li class="news_node"><a class="other" href="/no"></a><a class="news_item" href="/1"></a></li>'
            '<li class="news_node"><p>none</p></li><li class="news_node"><a class="news_item" href="http://x/2"></a></li>',
            ["https://www.mk.co.kr/1", "http://x/2"],
        ),
        ("mk_popular", '<a href="http://x/1"><div><h3 class="news_ttl">t</h3></div></a><h3 class="news_ttl">u</h3>', ["http://x/1"]),
        ("naver", '<a class="sa_text_title" href="/rel"></a><a class="sa_text_title" href="http://x/1"></a>', ["http://x/1"]),
        (
            "hankyung",
            '<ul class="news-list"><li><h3 class="news-tit"><a href="http://x/1"></a></h3>'
            '<ul><li><h3 class="news-tit"><a href="http://x/2"></a></h3></li></ul></li></ul>',
            ["http://x/1"],
        ),
    ],
)
def test_links_by_site(site, html, links):
    assert sites.read_links(html, sites.LINK_LISTS[site]) == links


def test_link_caps_count_items_before_the_filter():
    html = "".join(f'<a class="sa_text_title" href="{"/r" if i < 29 else "http://x/" + str(i)}"></a>' for i in range(40))
    links = sites.LINK_LISTS["naver"]
    assert sites.read_links(html, links, links.cap) == ["http://x/29"]
    assert len(sites.read_links(html, links)) == 11


@pytest.mark.parametrize(
    ("html", "inner"),
    [
        ("<article>a<article>b</article>c</article>d", "a<article>b</article>c"),
        ("<ARTICLE x>a<article>b</article><article>c</Article>d</article></article>", "a<article>b</article><article>c</Article>d"),
        ("<article>a</article><article>b</article>", "a"),
        ("<article>a<article>b</article>", ""),
        ("<articles>a</articles><article>b</article>", "b"),
        ("no", ""),
    ],
)
def test_an_element_ends_at_its_own_closing_tag(spark, html, inner):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(P.inner_html(F.col("html"), "article")).first()[0] == inner


def test_links_in_any_markup(spark):
    html = """<A HREF='/a'>x</A><a class='ad_wrap' href="/ad"></a><a title="q" href = "http://y/b'c">z</a>"""
    df = spark.createDataFrame([(html, "http://x/p")], "html string, url string")
    assert df.select(P.page_links(F.col("html"), F.col("url"))).first()[0] == ["http://x/a", "http://y/b'c"]
