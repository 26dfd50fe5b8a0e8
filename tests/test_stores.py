"""Report folders and the page store: reads, pushed filters, commits, aborts."""

import json
import time

import pytest
from pyspark.sql import functions as F

from filingloom.sources import files, stores


def test_reports(spark, tmp_path):
    root = str(tmp_path / "reports")
    rows = [("AB - Alpha + Beta", f"10-K 202{k} Q4.pdf", bytearray(b"text %d" % k), '{"ticker": "AB"}') for k in range(3)] + [("C - Co, 50%", "press.PDF", bytearray(b"x"), None), ("plain", "notes.txt", bytearray(b"y"), None)]
    df = spark.createDataFrame(rows, "folder string, file_name string, content binary, metadata string").repartition(2, "folder")
    stores.registered(spark)
    df.write.format("reports").option("path", root).mode("append").save()
    assert sorted(p.name for p in (tmp_path / "reports").iterdir()) == ["AB - Alpha + Beta", "C - Co, 50%", "plain"]
    got = {(r["ticker"], r["file_name"]): (r["folder"], r["metadata"], bytes(r["content"])) for r in spark.read.format("reports").option("path", root).option("content", "true").load().collect()}
    assert got == {("AB", f"10-K 202{k} Q4.pdf"): ("AB - Alpha + Beta", '{"ticker": "AB"}', b"text %d" % k) for k in range(3)} | {("C", "press.PDF"): ("C - Co, 50%", None, b"x")}
    found = sorted((r["ticker"], r["company_name"], r["document_type"], r["extracted_year"], r["extracted_quarter"]) for r in files.report_folder(spark, root).where("ticker = 'AB'").collect())
    assert found == [("AB", "Alpha + Beta", "10-K Annual Report", 2020 + k, 4) for k in range(3)]
    with pytest.raises(Exception, match="already"):
        df.write.format("reports").option("path", root).mode("append").save()
    df.where("folder = 'plain'").write.format("reports").option("path", root).mode("overwrite").save()
    assert not [p for p in (tmp_path / "reports").iterdir() if p.name.startswith("_")]


def test_folders_that_no_filter_wants_are_left_out(tmp_path):
    for t in ("A", "B", "C"):
        (tmp_path / f"{t} - x").mkdir()
        (tmp_path / f"{t} - x" / "f.pdf").write_text("x")
    (tmp_path / "deep" / "A - y").mkdir(parents=True)
    (tmp_path / "deep" / "A - y" / "g.pdf").write_text("x")
    reader = stores.ReportReader({"path": str(tmp_path)})
    list(reader.pushFilters([stores.In(("ticker",), ("A",)), stores.EqualTo(("file_name",), "f.pdf")]))
    parts = reader.partitions()
    assert [p.rsplit("/", 1)[-1] for s in parts[1:] for p in s.paths] == ["A - x", "deep"]
    names = [n for s in parts for b in reader.read(s) for n in b.column("file_name").to_pylist()]
    assert names == ["f.pdf", "g.pdf"]


def test_pages(spark, tmp_path):
    root = str(tmp_path / "pages")
    stores.registered(spark)
    pages = spark.range(40).select(F.concat(F.lit("https://x/"), F.col("id").cast("string")).alias("url"), F.lit("<p>").alias("html"), F.col("id").alias("n"))
    pages.where("n < 20").repartition(3).write.format("pages").option("path", root).mode("append").save()
    pages.where("n >= 20").repartition(2).write.format("pages").option("path", root).mode("append").save()
    read = spark.read.format("pages").option("path", root).load()
    assert read.columns == ["url", "html", "n"] and sorted(r["n"] for r in read.collect()) == list(range(40))
    assert [r["n"] for r in read.where("url = 'https://x/7'").collect()] == [7]

    def fail(n):
        if n == 33:
            raise ValueError("no")
        return n

    before = sorted((tmp_path / "pages" / "_commits").iterdir())
    bad = pages.repartition(4).withColumn("n", F.udf(fail, "long")("n"))
    with pytest.raises(Exception, match="no"):
        bad.write.format("pages").option("path", root).mode("append").save()
    named = {s for p in before for s in json.loads(p.read_text())["segments"]}
    assert sorted((tmp_path / "pages" / "_commits").iterdir()) == before
    until = time.monotonic() + 20  # tasks that were still at work end
    while time.monotonic() < until and {str(p.relative_to(tmp_path / "pages")) for p in (tmp_path / "pages" / "segments").rglob("*.parquet")} != named:
        time.sleep(0.5)
    left = {str(p.relative_to(tmp_path / "pages")) for p in (tmp_path / "pages" / "segments").rglob("*") if p.is_file()}
    assert left == named, (left, named)  # an aborted write leaves nothing
    pages.where("n = 1").write.format("pages").option("path", root).mode("overwrite").save()
    assert [r["n"] for r in spark.read.format("pages").option("path", root).load().collect()] == [1]
    with pytest.raises(Exception, match="no pages"):
        spark.read.format("pages").option("path", str(tmp_path / "none")).load()


def test_aborted_reports_leave_nothing(spark, tmp_path):
    def fail(n):
        if n == 3:
            raise ValueError("no")
        return bytearray(b"x")

    stores.registered(spark)
    df = spark.range(8).repartition(4).select(F.concat(F.lit("T"), F.col("id").cast("string"), F.lit(" - c")).alias("folder"), F.lit("a.pdf").alias("file_name"), F.udf(fail, "binary")("id").alias("content"), F.lit("{}").alias("metadata"))
    with pytest.raises(Exception, match="no"):
        df.write.format("reports").option("path", str(tmp_path / "r")).mode("append").save()
    until = time.monotonic() + 20  # tasks that were still at work end
    while time.monotonic() < until and list((tmp_path / "r").rglob("*.pdf")):
        time.sleep(0.5)
    assert not list((tmp_path / "r").rglob("*.*")) and not [p for p in (tmp_path / "r").iterdir() if not p.name.startswith("_")]


def test_a_number_before_the_name_says_no_year(spark, tmp_path):
    rows = [("A - x", f"{n} {name}", bytearray(b"x"), "{}") for n, name in ((2000, "other__Q2.pdf"), (12081, "10-q_2023_Q3.pdf"))]
    root = str(tmp_path / "r")
    files.write_reports(spark.createDataFrame(rows, "folder string, file_name string, content binary, metadata string"), root)
    got = files.report_folder(spark, root, numbered=True).collect()
    assert sorted((r["file_name"], r["document_type"], r["extracted_year"], r["extracted_quarter"]) for r in got) == [("12081 10-q_2023_Q3.pdf", "10-Q Quarterly Report", 2023, 3), ("2000 other__Q2.pdf", "Other PDF Document", None, 2)]
