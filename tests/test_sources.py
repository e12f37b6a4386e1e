import gzip

from pyspark.sql import functions as F

from hirelens.functions.html import html_to_text, resolve_url, shred
from hirelens.sources.comments import damaged_lines, parse_comments, read_hits, split_header
from hirelens.sources.listing import land_pages, page_elements, parse_listing, read_pages, url_allowed

SELECTORS = {
    "card": ["section.vacancy", "li.opening"],
    "title": ["h4.role", "strong"],
    "company": ["span.firm"],
    "location": ["span.place", "em"],
    "posted": ["time.on", "time"],
    "link": ["nav a.more", "a"],
}
NESTED = """<ul><li class="opening"><strong>outer</strong><em>Ghent</em>
<ul><li class="opening"><strong>inner</strong><time datetime="">yesterday</time><a>no target</a></li></ul></li></ul>"""
BOTH = """<li class="opening"><strong>not served</strong></li>
<section class="x vacancy y"><h4 class="role">Night &lt;Shift&gt; Nurse</h4><span class="firm">St. Anna</span>
<time class="on" datetime="2023-11-30">a day</time><time datetime="2000-01-01">b</time>
<a href="one">1</a><a href="?two">2</a></section>
<section class="vacancy"><span class="firm">Untitled Ltd</span></section>
<section class="vacancy"><h4 class="role"> </h4><strong>Baker</strong><nav><a class="more" href="/three">3</a></nav><a href="four">4</a></section>"""


def listed(spark, page):
    pages = spark.createDataFrame([(4, "https://board.test/a/b", page)], "page_id long, url string, html string")
    return parse_listing(pages, SELECTORS).orderBy("ordinal").collect()


def test_first_card_selector_with_a_match_serves_the_page(spark):
    nurse, baker = listed(spark, BOTH)
    assert (nurse.title, nurse.company, nurse.posted, nurse.url) == (
        "Night <Shift> Nurse", "St. Anna", "2023-11-30", "https://board.test/a/b?two")
    assert (baker.title, baker.company, baker.location, baker.posted) == ("Baker", None, None, None)
    assert baker.url == "https://board.test/three" and baker.ordinal > nurse.ordinal


def test_cards_inside_cards(spark):
    outer, inner = listed(spark, NESTED)
    assert (outer.title, outer.location, outer.posted) == ("outer", "Ghent", "yesterday")
    assert (inner.title, inner.location, inner.posted, inner.url) == ("inner", None, "yesterday", None)


def test_page_without_cards_gives_no_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>nothing</p>")], "page_id long, url string, html string")
    assert parse_listing(pages, SELECTORS).count() == 0


def test_elements_nest_and_skip_scripts(spark):
    pages = spark.createDataFrame(
        [(1, "<div id=x><p>a<b>b</p><script>no</script><br>c</div><h1>d</h1>")], "page_id long, html string"
    )
    rows = {r.tag: r for r in page_elements(pages).collect()}
    assert rows["div"].text == "a b c" and rows["div"].attrs == {"id": "x"}
    assert rows["div"].end_seq == rows["br"].seq and rows["h1"].seq == 5
    assert rows["script"].text == "no" and rows["p"].text == "a b"


def test_urls_resolve(spark):
    cases = [
        ("https://h.test/a/b?q#f", "c", "https://h.test/a/c"),
        ("https://h.test/a/b", "/x/../y/./z", "https://h.test/y/z"),
        ("https://h.test/a/b", "//o.test/p", "https://o.test/p"),
        ("https://h.test/a/b?q#f", "?z", "https://h.test/a/b?z"),
        ("https://h.test/a/b?q#f", "#g", "https://h.test/a/b?q#g"),
        ("https://h.test", "x", "https://h.test/x"),
        ("https://h.test/a/", "../../..", "https://h.test/"),
        ("https://h.test/a/", "mailto:a@b", "mailto:a@b"),
        ("https://h.test/a/", "http://o/../p", "http://o/../p"),
    ]
    df = spark.createDataFrame([(b, h, w) for b, h, w in cases], "b string, h string, w string")
    for r in df.select("*", resolve_url(F.col("b"), F.col("h")).alias("got")).collect():
        assert r.got == r.w, (r.b, r.h)
    from urllib.parse import urljoin
    for base, href, want in cases:
        assert urljoin(base, href) == want


def test_html_to_text(column):
    values = [
        "a<p>b<br>c<BR/>d &#x24;5 &amp;lt; &eacute;", "x &amp; y &lt;b&gt; it&#x27;s", "1 < 2 <a href=\"u>v\">l</a>",
        "<!-- <p>no</p> --><script>no</script>yes<pre>z</pre>", None,
    ]
    assert column(values, html_to_text) == [
        "a\nb\nc\nd $5 &lt; é", "x & y <b> it's", "1 < 2 l", "yesz", None,
    ]


def test_header_split(column):
    values = [
        "Quarry | Senior Driver | Night Driver | Leeds", "Quarry | Leeds | Part-time | Plumber", "Quarry | Tester | Tester | Bonn",
        " Quarry  |  Data Analyst ", "Quarry |", "||", "no bars at all", "q" * 80 + " | Cook", "q" * 81 + " | Cook",
        "Quarry | " + "r" * 292, "Quarry | Cook | 55k - 60k EUR | onsite | Graz", None,
    ]
    got = [tuple(r) if r else None for r in column(values, split_header)]
    assert got[0][:2] == ("Quarry", "Senior Driver") or got[0][:2] == ("Quarry", "Night Driver")
    assert got[3] == ("Quarry", "Data Analyst", None)
    assert got[4:7] == [None, None, None]
    assert got[7] is not None and got[7][0] == "q" * 80 and got[8] is None and got[9] is None
    assert got[10][0] == "Quarry" and got[11] is None


def test_comments(spark):
    rows = [
        (1, "11", "2024-01-02T03:04:05Z", "Umbrella | SRE | Lyon | &#x24;90k<p>We &lt;3 Go &amp; SQL<p> "),
        (2, "12", None, "Thanks!"),
        (3, "13", None, None),
        (4, None, None, "Beta | Developer"),
        (5, "15", None, "Beta | Developer<p>" + "long text " * 300),
    ]
    df = spark.createDataFrame(rows, "ordinal long, objectID string, created_at string, comment_text string")
    got = {r.ordinal: r for r in parse_comments(df).collect()}
    assert sorted(got) == [1, 4, 5]
    assert got[1].url == "https://news.ycombinator.com/item?id=11"
    assert got[1].description == "Umbrella | SRE | Lyon | $90k\nWe <3 Go & SQL"
    assert got[1].posted == "2024-01-02T03:04:05Z" and got[1].location == "Lyon"
    assert got[4].url is None and got[4].location is None
    assert len(got[5].description) == 1500 and got[5].description.endswith("long…") or got[5].description.endswith("…")


def test_first_rule_of_the_host_decides(spark):
    rules = spark.createDataFrame(
        [("h.test", 1, "/private/open", True), ("h.test", 2, "/private", False), ("h.test", 3, "", False)],
        "host string, ord int, prefix string, allow boolean",
    )
    urls = {
        "https://h.test/private/x": False, "https://h.test/private/open/1": True,
        "https://h.test/": True, "https://other.test/private": True,
    }
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.allowed for r in url_allowed(pages, rules).collect()} == urls
    assert url_allowed(pages, rules, respect=False).filter("allowed").count() == 4


def test_shred_can_keep_only_some_tags(spark):
    df = spark.createDataFrame([("<div><i>x</i><p>y</p></div>",)], "h string")
    (elements,) = df.select(shred(F.col("h"), ["div", "p"])).first()
    assert [(e.tag, e.seq, e.end_seq) for e in elements] == [("div", 0, 1), ("p", 1, 1)]


def test_files_with_equal_names_are_different_pages(spark, tmp_path):
    for folder, page in (("h2", 1), ("h1", 10), ("h1", 9), ("h1", 1)):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"page{page}.html").write_text(f"<p>{folder} {page}</p>")
    found = read_pages(spark, str(tmp_path / "*")).orderBy("page_id").collect()
    assert [r.page_id for r in found] == [0, 1, 2, 3]
    assert [r.html for r in found] == ["<p>h1 1</p>", "<p>h1 9</p>", "<p>h1 10</p>", "<p>h2 1</p>"]


def test_landed_pages_are_files_that_are_opened_once(spark, tmp_path):
    texts = {0: "<p>zero</p>", 2: "<p>two\nlines é</p>", 10: None, -5: "<p>minus</p>", None: "<p>none</p>"}
    pages = spark.createDataFrame(list(texts.items()), "page_id long, html string").repartition(3)
    folder = tmp_path / "landed"
    land_pages(pages, str(folder))
    assert len(list(folder.iterdir())) == len(texts) and all(f.is_file() for f in folder.iterdir())
    found = read_pages(spark, f"file:{folder}")
    # Nothing of it is read from the files again.
    for file in folder.iterdir():
        file.write_text("<p>later</p>")
    want = [(texts[n] or "") + "\n" for n in (-5, 0, 2, 10, None)]
    assert [(r.page_id, r.html) for r in found.orderBy("page_id").collect()] == list(enumerate(want))
    land_pages(pages.limit(0), str(tmp_path / "nothing"))
    assert read_pages(spark, str(tmp_path / "nothing")).count() == 0


def test_packed_pages_are_unpacked(spark, tmp_path):
    (tmp_path / "page2.html").write_text("<p>plain</p>")
    (tmp_path / "page1.html.gz").write_bytes(gzip.compress(b"<p>packed</p>"))
    assert [(r.page_id, r.html) for r in read_pages(spark, str(tmp_path)).orderBy("page_id").collect()] == [
        (0, "<p>packed</p>"), (1, "<p>plain</p>")]


def test_damaged_lines_are_counted(spark, tmp_path):
    path = tmp_path / "feed.jsonl"
    path.write_text('{"hits": [{"objectID": "1"}]}\n{"hits": [{"obj\n\n{"hits": []}\n')
    assert damaged_lines(spark, str(path)) == 1
    assert read_hits(spark, str(path)).count() == 1
