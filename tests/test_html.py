"""Page parsing on a small hand-written corpus."""

from filingloom.operators import html

PAGE = """<html><head><title> My <!-- c -->page </title><meta name="description" content="d"><meta property="og:title" content="OG"><meta name="odd" content="x"><script>var a = '<a href="/no">no</a>';</script></head>
<body><nav><a href="/home">Home</a></nav><article><h2>Two</h2><h1>One <b>bold</b></h1><p>A paragraph with <b>more</b> than twenty letters<p>tiny</p>
<a href="report.pdf">Report</a><a href="report.pdf?x=1">Query</a><a href="#top">Top</a><a href="javascript:x()">J</a><a href="mailto:a@b.c">M</a><a href="//other.com/x" title="T">Other</a><a class="main-menu" href="/m">Menu</a>
<img src="/a.png" alt="A"><table><thead><tr><th>K</th><th>V</th></tr></thead><tbody><tr><td>a</td><td><a href="/quotes/ab">AB</a></td></tr></tbody><tfoot><tr><td>sum</td></tr></tfoot></table>
<table><tr><th>H</th></tr><tr><td>1</td><td>2</td></tr></table></article></body></html>"""


def test_page():
    got = html.page(PAGE, "https://site.com/dir/page", tuple(html.KINDS))
    assert got["title"] == "OG"  # a title of several parts has no single text
    assert got["metadata"] == {"description": "d", "og:title": "OG"}
    assert got["headings"] == [{"level": 1, "text": "Onebold"}, {"level": 2, "text": "Two"}]
    kinds = {(x["category"], x["url"]) for x in got["links"]}
    assert kinds == {("navigation", "https://site.com/home"), ("internal", "https://site.com/dir/report.pdf"), ("internal", "https://site.com/dir/report.pdf?x=1"), ("external", "https://other.com/x"), ("navigation", "https://site.com/m"), ("internal", "https://site.com/quotes/ab")}
    assert got["documents"] == [{"url": "https://site.com/dir/report.pdf", "text": "Report", "type": "PDF"}]
    assert got["images"] == [{"url": "https://site.com/a.png", "alt": "A", "title": ""}]
    first, second = got["tables"]
    assert first["headers"] == [["K", "V"]] and first["body"] == [["a", "AB"]] and first["footer"] == [["sum"]] and first["links"][0]["is_company_profile"] and first["column_count"] == 2
    assert second["headers"] == [["H"]] and second["body"] == [["1", "2"]] and second["row_count"] == 1
    assert got["content"]["paragraphs"][0].startswith("A paragraph withmorethan twenty letters")


def test_limits():
    page = "<body>" + "<table><tr><td>x</td></tr></table>" * 7 + '<img src="a">' * 25 + "<p>" + "y" * 30 + "</p>" + ("<p>" + "z" * 25 + "</p>") * 60
    got = html.page(page, None, ("tables", "images", "content"))
    assert (len(got["tables"]), len(got["images"]), len(got["content"]["paragraphs"])) == (5, 20, 50)


def test_empty(spark):
    df = spark.createDataFrame([(1, None, None), (2, "https://a.com", ""), (3, "u", "</p></x><b>")], "page_id int, url string, html string")
    got = html.parsed(df).collect()
    assert len(got) == 3 and all(r["title"] == "" and r["links"] == [] for r in got)


def test_index_rows(spark):
    df = spark.createDataFrame([(1, "https://site.com/", PAGE)], "page_id int, url string, html string")
    assert [r["ticker"] for r in html.index_rows(df, "https://site.com").collect()] == ["AB"]


def test_rendered(spark):
    rows = spark.createDataFrame([("u", "<title>T</title><script>no</script><p>a <b>b</b></p>c"), ("v", None)], "url string, html string")
    assert {r["url"]: r["text"] for r in html.rendered(rows).collect()} == {"u": "T\na\nb\nc", "v": None}


def sql_rows(spark, folder, name):
    """A query's rows and those of its SQL, over pages whose titles and headings hold references of all kinds."""
    import duckdb

    from filingloom.plans import oracle, queries

    said = ["a &quot;b&quot; &lt;c&gt; &amp; d", "cut &amp", "cut &am", "twice &amp;quot; &amp;lt;", "&#39;x&#39; &nbsp; &copy 1 &notit;", "R&D & co", "&lt &gt"]
    pages = [(k, "https://a.example.com/", f'<html><head><title>{t}</title></head><body><h1>{t}</h1><a href="/x?a=1&amp;b=2">z</a></body></html>') for k, t in enumerate(said)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    db = duckdb.connect()
    db.sql(f"create view pages as select * from '{folder}/pages.parquet/*.parquet'")
    got, want = queries.QUERIES[name](spark, str(folder)), db.sql(oracle.ORACLE[name])
    return sorted(map(tuple, got.select(want.columns).collect())), sorted(want.fetchall())


def test_references_in_titles_as_in_sql(spark, tmp_path):
    got, want = sql_rows(spark, tmp_path, "page_titles")
    assert got == want and got[0] == (0, "a &quot;b&quot; <c> & d")


def test_references_in_headings_as_in_sql(spark, tmp_path):
    got, want = sql_rows(spark, tmp_path, "page_headings")
    assert got == want and got[0] == (0, 0, 1, "a &quot;b&quot; <c> & d")
