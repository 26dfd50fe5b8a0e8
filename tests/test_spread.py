"""Work that follows rows is dealt by rows, however small the files; pages parsed the short way are those parsed in full."""

import random

from filingloom.operators import html
from filingloom.plans import queries, views
from filingloom.sources.stage import spread

BITS = ["<p>", "</p>", "<title>", "</title>", '<a href="x.pdf">', "</a>", "<br>", "<br/>", '<IMG SRC="a" alt="b c">', "text", "&amp;", "&quot", "a & b", "<table><tr><td>", "</td></tr></table>", "<!-- c -->", "<script>", "</script>", "<a href=x>", "\n", "<h1>", "</h1 >", "<", ">", "<textarea>", '"', "<x-y>", '<meta name="description" content="q&amp;r">', "<title/>", '<p a="1" a="2">']


def test_rows_of_one_file_go_to_many_tasks(spark, tmp_path):
    spark.range(3000).selectExpr("id p_partkey", "'n' p_name", "'B' p_brand", "'t' p_type", "1 p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for name in ("v_wrapped", "v_intents"):
        assert views.view(spark, str(tmp_path), name, rows=1000).rdd.getNumPartitions() == 3
    assert queries.page_content(spark, str(tmp_path)).rdd.getNumPartitions() == 3
    assert spread(spark.range(0)).count() == 0


def test_batches_are_cut(spark, monkeypatch):
    rows = [(k, "https://a.com", f"<h1>{k}</h1>") for k in range(25)]
    monkeypatch.setattr(html, "SLICE", 10)
    got = html.parsed(spark.createDataFrame(rows, "page_id int, url string, html string").coalesce(1), "title")
    assert sorted((r["page_id"], r["title"]) for r in got.collect()) == [(k, str(k)) for k in range(25)]


def test_the_short_way_agrees(monkeypatch):
    rng, kinds = random.Random(4), tuple(html.KINDS)
    pages = ["<p>" + "".join(rng.choice(BITS) for _ in range(rng.randint(0, 9))) + "</p>" for _ in range(4000)]
    short = [html.page(p, "https://a.com/b", kinds) if html.simple(p) is not None else None for p in pages]
    monkeypatch.setattr(html, "simple", lambda _: None)
    assert sum(x is not None for x in short) > 500
    assert all(x is None or x == html.page(p, "https://a.com/b", kinds) for p, x in zip(pages, short, strict=True))
