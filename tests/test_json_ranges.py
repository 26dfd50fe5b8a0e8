"""Records of one JSON text read in small ranges, against the text read whole."""

import json
import random

import pytest

from filingloom.sources import files, json_ranges

POOL = ["a", '"', "\\", "{", "}", "[", "]", ",", ":", "é", "😀", "\n", " ", '\\"', "\\\\"]


@pytest.fixture(params=["211", "10m"])
def ranges(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def some(rng):
    return "".join(rng.choice(POOL) for _ in range(rng.randint(0, 12)))


def test_lists(spark, tmp_path, ranges, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(json_ranges, "RUN", 7)
    rows = [{"t": some(rng), "n": i, "m": {"x": some(rng), "y": [{"z": some(rng)}]} if i % 3 else None} for i in range(30)]
    (tmp_path / "in.json").write_text(json.dumps([1, "}{", None, *rows, []], ensure_ascii=False, indent=1))
    got = sorted((r["ord"], r["value"]) for r in json_ranges.objects(spark, str(tmp_path / "in.json")).collect())
    assert [o for o, _ in got] == list(range(30)) and [json.loads(v) for _, v in got] == rows
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "in.json")).rdd.getNumPartitions() > (10 if ranges == "211" else 0)


def test_documents(spark, tmp_path, ranges, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(json_ranges, "RUN", 5)
    docs = {some(rng) + str(k): [{"title": some(rng), "url": str(i), "metadata": {"ticker": "x", "company": some(rng)}} for i in range(rng.randint(0, 6))] for k in range(8)}
    latest = {k: {"title": "no", "metadata": {"ticker": "no", "company": "{"}} for k in docs}
    whole = {"count": 3, "note": "}{[", "all_documents": docs, "latest_quarterly_reports": latest, "more": {"u": [{"title": "no"}]}}
    want = sorted((k, i, x["title"], x["metadata"]["company"]) for k, v in docs.items() for i, x in enumerate(v))
    for name, text in (("bare", docs), ("wrapped", whole)):
        (tmp_path / name).write_text(json.dumps(text))
        assert sorted((r["ticker"], r["ord"], r["title"], r["metadata"]["company"]) for r in files.documents(spark, str(tmp_path / name)).collect()) == want
    for name, text in (("none", []), ("empty", {}), ("blank", {"all_documents": {"A": []}})):
        (tmp_path / name).write_text(json.dumps(text))
        assert files.documents(spark, str(tmp_path / name)).count() == 0 and json_ranges.objects(spark, str(tmp_path / name)).count() == 0


def test_parts_make_one_text(spark, tmp_path, ranges):
    rng = random.Random(3)
    rows = [(f"T{k % 9}" if k else 'T"\\', k, some(rng), f"u{k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "ticker string, ord int, title string, url string").repartition(3)
    latest = docs.where("ord > 30").select("ticker", "title", "url")
    files.write_document_map(docs, latest, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    back = json.loads(text)
    assert {k: [x["title"] for x in v] for k, v in back["all_documents"].items()} == {k: [t for a, _, t, _ in rows if a == k] for k in {r[0] for r in rows}}
    assert {k: v["url"] for k, v in back["latest_quarterly_reports"].items()} == {a: u for a, k, _, u in rows if k > 30}
    got = files.documents(spark, str(tmp_path / "out"), together=True).collect()
    assert sorted((r["ticker"], r["ord"], r["title"]) for r in got) == sorted((k, i, x["title"]) for k, v in back["all_documents"].items() for i, x in enumerate(v))
    files.write_document_map(docs.where("false"), latest.where("false"), str(tmp_path / "none"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))) == {"all_documents": {}, "latest_quarterly_reports": {}}


def test_a_part_may_end_anywhere(spark, tmp_path):
    docs = {f"T{t}": [{"title": f"t{t} {k}", "url": "u"} for k in range(3)] for t in range(2)}
    lines = ['{"all_documents": {', *(x for t, v in docs.items() for x in (("" if t == "T0" else ",") + f'"{t}": [', *("," * (k > 0) + json.dumps(d) for k, d in enumerate(v)), "]")), "}}"]
    for cut in (3, 5):  # after a document, and before the end of a list
        root = tmp_path / str(cut)
        root.mkdir()
        for n, part in enumerate((lines[:cut], lines[cut:])):
            (root / f"part-{n}").write_text("".join(x + "\n" for x in part))
        got = files.documents(spark, str(root), wrapped=True, together=True).collect()
        assert sorted((r["ticker"], r["ord"], r["title"]) for r in got) == sorted((t, k, d["title"]) for t, v in docs.items() for k, d in enumerate(v)), cut
