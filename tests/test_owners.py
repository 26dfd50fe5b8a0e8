"""The stream of first owners: any order of arrival gives the batch operators' rows."""

import random

import pytest

from filingloom.operators import ranking
from filingloom.streaming import owners
from filingloom.streaming.host_crawl import until_quiet


def rows(seed):
    rng = random.Random(seed)
    out = []
    for k in range(60):
        company = rng.randint(0, 4)
        out.append((f"C{company}", rng.choice(["A", "B"]), k, company, rng.randint(0, 2), f"t{k}", f"https://x.com/{rng.randint(0, 25)}.pdf" if k % 7 else "https://x.com/page", float(rng.randint(0, 3)), rng.choice([None, 2022, 2023]), rng.choice([None, 1, 4])))
    return out


def want(spark, given):
    first = ranking.owner_of_address(spark.createDataFrame(given, owners.DOCUMENT))
    return sorted(map(tuple, ranking.latest_per_type(first).select("ticker", "document_type", "ord").collect())), sorted(r["ord"] for r in first.collect())


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_any_order_of_arrival(spark, tmp_path, order):
    given = rows(3)
    parts = [given[k::3] for k in order]
    for k, part in enumerate(parts):
        spark.createDataFrame(part + parts[0][:5], owners.DOCUMENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(owners.DOCUMENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = owners.start(source, str(tmp_path / "out"))  # from the checkpoint each time
        until_quiet(query, 0.0, batches=2, most=120)
        query.stop()
        so_far = [r for p in parts[: k + 1] for r in p]
        sink = owners.Sink(spark, str(tmp_path / "out"))
        assert (sorted(map(tuple, sink.latest().select("ticker", "document_type", "ord").collect())), sorted(r["ord"] for r in sink.owners().collect())) == want(spark, so_far)


def test_sink_takes_a_batch_once(spark, tmp_path):
    schema = owners.TABLES["owners"]
    sink = owners.Sink(spark, str(tmp_path))
    one = [("u", "C2", "A", 1, 2, 0, "t", "u.pdf", 1.0, 2022, None)]
    sink.upsert(spark.createDataFrame(one, schema), 0)
    sink.upsert(spark.createDataFrame(one, schema), 0)
    assert sink.log.number == 1 and [r["ticker"] for r in sink.latest().collect()] == ["C2"]
    sink.upsert(spark.createDataFrame([("u", "C1", "A", 9, 1, 0, "t", "u.pdf", 1.0, 2022, None)], schema), 1)  # an earlier owner comes late
    again = owners.Sink(spark, str(tmp_path))
    assert [(r["ticker"], r["ord"]) for r in again.latest().collect()] == [("C1", 9)] and [r["ticker"] for r in again.owners().collect()] == ["C1"]


def test_addresses_are_kept_by_built_in_state(spark, tmp_path):
    """What goes on: the first, nothing for a later or equal one, an earlier one; without Python for each address."""
    came = []
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(owners.DOCUMENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for k, ord_ in enumerate((5, 9, 5, 2)):
        spark.createDataFrame([("C1", "A", ord_, 1, 0, "t", "https://x.com/a.pdf", 1.0, 2022, 1)], owners.DOCUMENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = owners.first_owners(source).writeStream.outputMode("update").foreachBatch(lambda batch, _: came.extend(r["ord"] for r in batch.collect()))
        query = query.option("checkpointLocation", str(tmp_path / "checkpoint")).start()
        until_quiet(query, 0.0, batches=2, most=60)
        query.stop()
        assert {s["operatorName"] for s in query.lastProgress["stateOperators"]} == {"stateStoreSave"}, k
    assert came == [5, 2]
