"""Text and pictures of pages."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curate.functions.html import SELECTORS
from curate.functions.html_tree import page_text
from curate.operators import pages as P

TEXTS = {
    "<p>no body": None,
    "": None,
    "<body>x<nav>n</nav>y<div class='a sidebar'>q<div>r</div></div>z</body>": "x\ny\nz",
    "<div class='content x'>a<div>b</div>c</div>": "a\nb\nc",
    "<div class='contents'>a</div><body>k</body>": "k",
    "<div id=content>a</div><main>m</main>": "m",
    "<article></article>": "",
    "<article>un<b>closed": "un\nclosed",
    "<article>a &eacute; &amp;lt; b<script>var x='<article>'</script>c<!-- <p> -->d</article>": "a é &lt; b\nc\nd",
    "<script>'<article>x</article>'</script><main>m</main>": "m",
    "<div role='main'> q  </div>": "q",
    "<article>a<article>b</article>c</article>": "a\nb\nc",
    "<p title=\"a>b\">x</p><article><p title=\"a > b\">x it's</p>y</article>": "x it's\ny",
    "<body><header>h<nav>i</nav></header>t<footer>f</body>": "t",
    "<body>a<aside>b<aside>c</aside>d</aside>e</body></html> tail": "a\ne",
    "<ARTICLE>Up</ARTICLE>": "Up",
    "<section data-role=\"main\">x</section><body>k</body>": "k",
    "<div><article>a</div>b</article>": "a",
    "<article>R&D AT&T a < b &copy 2</article>": "R&D AT&T a < b © 2",
    "<article>x &nbsp; <br/>y&#8217;s</article>": "x\ny’s",
    "<article>a<ruby>b<rt>c</rt></ruby><template>t</template></article>": "a\nb",
    "<article>  two\n words  <i>\t</i>\n</article>": "two\n words",
    "<article>a\x01b</article>": "a\x01b",
    "<body><p data-q='a class=\"content\" b'>p</p>q</body>": "p\nq",
    "<body><p title=\"see id='content' x\">p</p>q</body>": "p\nq",
    "<article " + " ".join(f'a{i}="{i}"' for i in range(300)) + ">many</article>": "many",
}


@pytest.fixture(scope="module")
def read(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "page_id int, html string")
    return {row.page_id: row.content for row in P.main_content(df).collect()}


@pytest.mark.parametrize("number", range(len(TEXTS)))
def test_main_content(read, number):
    html, wanted = list(TEXTS.items())[number]
    assert read[number] == wanted
    assert page_text(html, SELECTORS) == wanted


NESTING = st.recursive(
    st.sampled_from(["a", "b c", "<br>", "<p>x", "<p>y</p>", "<img src='i.png'/>", "&amp;", " ", "é"]),
    lambda inner: st.builds(
        lambda tag, parts: f"<{tag}>{''.join(parts)}</{tag.split()[0]}>",
        st.sampled_from(["div", "section", "article", "main", "div class='content x'", "DIV", "section id=content", "span", "li",
                         "p title='a class=\"content\"'", "div class=\"post-content\""]),
        st.lists(inner, max_size=4),
    ), max_leaves=12,
)


def random_pages(n=400):
    """Random nestings of containers, now and then with a tag missing."""
    found = []

    @settings(max_examples=n, deadline=None, database=None, derandomize=True)
    @given(st.lists(NESTING, max_size=3), st.booleans(), st.integers(0, 400))
    def draw(parts, bodied, cut):
        html = "".join(parts)
        html = f"<body>{html}</body>" if bodied else html
        found.append(html)
        # One of the tags left out.
        found.append(html[:cut] + html[html.find(">", cut) + 1:] if cut < len(html) else html)

    draw()
    return sorted(set(found))


def test_nested_containers_are_read_by_expressions(spark):
    pages = random_pages()
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").repartition(8)
    found = {row.page_id: row.content for row in P.main_content(df).collect()}
    assert found == {number: page_text(html, SELECTORS) for number, html in enumerate(pages)}
    nested = [
        (0, "<div class=content>" + "<div>a" * 50 + "</div>" * 50 + "b</div>c"), (1, "<article><section><article>x</article></section>y</article>z"),
        (2, "<main><div>q<main>r</main></div>s<p>t</main>u"), (3, "<section id='content'><section><div/>v</section>w</section>"),
        (4, "<DIV CLASS='content'>a<div>b</DIV>c</div>d"), (5, "<body><p title='a class=\"content\"'>x</p></body>"),
    ]
    df = spark.createDataFrame(nested, "page_id int, html string")
    read = P.read_by_expressions(df).orderBy("page_id").collect()
    assert [row._rest for row in read] == [None] * len(nested)
    assert [row._text for row in read] == [page_text(html, SELECTORS) for _, html in nested]
    plan = P.read_by_expressions(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_no_given_page_goes_to_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    nested = pages.withColumn("html", F.regexp_replace("html", "<p>", "<article><p>")).withColumn(
        "html", F.regexp_replace("html", "</p>", "</p></article>"))
    for given_pages in (pages, nested):
        assert P.read_by_expressions(given_pages).where("_rest IS NOT NULL").count() == 0
    found = {row.page_id: row.content for row in P.main_content(nested).collect()}
    assert found == {row.page_id: page_text(row.html, SELECTORS) for row in nested.collect()}


def test_selector_hit_tells_values_from_attributes(spark):
    pages = {
        "<body><div title='a class=\"content\"'>x</div>": "body", "<body><div title=\"see id='content' b\" x='a role=main'>x</div>": "body",
        "<div title='a class=\"b\"' class='content'>x</div>": ".content", "<p data-x='1' id=\"content\">": "#content", "<p>": None,
    }
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    rows = P.selector_hit(df).orderBy("page_id").collect()
    assert [row.selector for row in rows] == list(pages.values()) and rows[0].html == list(pages)[0]


def test_both_readings_agree_on_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {row.page_id: row.content for row in P.main_content(pages).collect()}
    assert found == {row.page_id: page_text(row.html, SELECTORS) for row in pages.collect()}


def test_few_pages_go_to_python(spark):
    """Only pages that need the tag-by-tag reading are handed over."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    plan = P.main_content(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("FileScan") == 1


def test_filters_do_not_copy_the_extraction(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    filtered = P.main_content(pages).where(F.lower("content").contains("a") | (F.col("content") != ""))
    assert filtered._jdf.queryExecution().optimizedPlan().toString().count("<!--") == 1


IMAGES = {
    '<img src="/logo.png"><img data-src="x.jpg" src="data:image/png;base64,a.jpg"><img width=50 src=a.jpg>'
    '<img width="100%" height="50" src="pix/b.JPG">': "http://h.com/p/pix/b.JPG",
    "<!-- <img src='z.jpg'> --><img src=//c.d/e.webp height=200>": "http://c.d/e.webp",
    "<img>": None,
    "<img src='upload/x.jpg'><img src='head.png'><img src='/ok.png' width='100'>": "http://h.com/ok.png",
    "<img src='a.gif'><img src='a.jpg?x=1'>": None,
    "<img src='a.jpg' width='0' height='99'><img src='b.jpg' width='-5'>": "http://h.com/p/b.jpg",
    "<img src='../up.jpeg' width='abc' height='1'>": "http://h.com/up.jpeg",
}


def test_first_image(spark):
    df = spark.createDataFrame([(i, "http://h.com/p/q?r", html) for i, html in enumerate(IMAGES)],
                               "i int, url string, html string")
    assert [row.image_url for row in P.first_image(df).orderBy("i").collect()] == list(IMAGES.values())


NAMED = {
    '<meta content="u&amp;v" property="og:image"/>': "u&v",
    '<meta property="og:image" content="x?a=1&#038;b=&eacute;&#xE9;&nothing;">': "x?a=1&b=éé&nothing;",
    '<meta title="a > b" property="og:image" content="c>d">': "c>d",
    '<meta content="no"><meta property="og:image" content="yes"><meta property="og:image" content="later">': "yes",
    "<meta property='og:image' content=''>": None,
    "<meta property='og:image:alt' content='x'><meta name='a' property=og:image content=b>": "b",
    "<p>none": None,
}


def test_og_image(spark):
    df = spark.createDataFrame([(i, html) for i, html in enumerate(NAMED)], "i int, html string")
    assert [row.image_url for row in P.og_image(df).orderBy("i").collect()] == list(NAMED.values())


def test_thumbnail_order_and_reachability(spark):
    page = '<meta property="og:image" content="https://i/og.jpg"><img src="https://i/first.jpg">'
    articles = spark.createDataFrame(
        [(1, "https://www.youtube.com/watch?v=a"), (2, "//p.com/2"), (3, "https://p.com/3"), (4, "https://youtube.com/watch?v=a")],
        "id bigint, url string")
    pages = spark.createDataFrame(
        [("https://www.youtube.com/watch?v=a", page), ("https://p.com/2", page), ("https://p.com/3", "<p>")], "url string, html string")
    status = [("https://img.youtube.com/vi/a/0.jpg", 200), ("https://i/og.jpg", 404), ("https://i/first.jpg", 200),
              ("https://i/first.jpg", 500)]
    picked = P.thumbnail_pick(articles, pages, spark.createDataFrame(status, "url string, status_code int"))
    assert {row.id: row.thumbnail_url for row in picked.collect()} == {
        1: "https://img.youtube.com/vi/a/0.jpg", 2: "https://i/first.jpg"}


def test_pages_are_chosen_without_their_html(spark, tmp_path):
    rows = [("https://a/1", f"old {i}", 1, i) for i in range(50)] + [("//a/1", "new", 2, 0), ("a/1", "new", 2, 0), ("http://b/2", "b", None, 7),
                                                                   ("http://b/2", "b", None, None), ("http://c/3", "c", 1, 1)]
    path = str(tmp_path / "pages")
    spark.createDataFrame(rows, "url string, html string, fetched_at int, page_id int").repartition(4).write.parquet(path)
    entries = spark.createDataFrame([(1, "https://a/1"), (2, "http://b/2"), (3, "//a/1"), (4, "http://none")], "id bigint, link string")
    for pages in (spark.read.parquet(path), spark.createDataFrame(rows, "url string, html string, fetched_at int, page_id int")):
        found = P.entry_page(entries, pages)
        assert sorted((row.id, row.html) for row in found.collect()) == [(1, "new"), (2, "b"), (3, "new"), (4, None)]
        kept = P.page_of_article(entries.where("id < 3"), pages)
        assert sorted((row.id, row.html) for row in kept.collect()) == [(1, "new"), (2, "b")]
    # What is sorted or ranked holds no html.
    pages = P.located(spark.read.parquet(path))
    plan = P.latest_pages(pages, entries.select(F.col("link").alias("page_url")))._jdf.queryExecution().executedPlan().toString()
    assert all("html" not in line for line in plan.splitlines() if any(word in line for word in ("Sort", "Window", "Exchange")))
    plan = P.with_html(P.latest_pages(pages), pages)._jdf.queryExecution().executedPlan().toString()
    assert not any("html" in line for line in plan.splitlines() if "Sort [" in line or "Window" in line or "Exchange hash" in line)
