"""Status partials kept up to date batch by batch."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.dates import month_num
from ledgerlens.operators.status import status_breakdown, status_columns
from ledgerlens.plans.loading import stage_db
from ledgerlens.sources import rollup as R
from ledgerlens.tables import header_with_territory
from tests.conftest import SF_SMALL

KEYS = ["_m", "territoryid"]


@pytest.fixture
def name(spark):
    return f"{stage_db(spark)}.rollup"


def header(spark):
    return header_with_territory(spark, SF_SMALL).withColumn("_m", month_num("orderdate"))


def report(spark, name):
    return sorted(map(tuple, status_columns(R.partials(spark, name, KEYS), KEYS).collect()))


def test_equal_to_the_report_over_all_rows(spark, name, tmp_path):
    parts = []
    for i in range(3):
        path = f"{tmp_path}/part{i}"
        header(spark).where(F.pmod("salesorderid", F.lit(3)) == i).write.parquet(path)
        parts.append(path)
    for i, path in enumerate(parts):
        rows = spark.read.parquet(path)
        read = R.with_batch(rows, name, KEYS, f"b{i}", "status", "totaldue").inputFiles()
        assert all(other not in f for f in read for other in parts if other != path)  # the batch and the rollup only
        assert R.add_batch(rows, name, KEYS, f"b{i}")
        assert not R.add_batch(rows, name, KEYS, f"b{i}")
    assert sorted(R.taken_batches(spark, name)) == ["b0", "b1", "b2"]
    assert report(spark, name) == sorted(map(tuple, status_breakdown(header(spark), KEYS).collect()))


def test_a_batch_that_fails_changes_nothing(spark, name):
    rows = header(spark)
    R.add_batch(rows.where("status = 1"), name, KEYS, "a")
    before = report(spark, name)
    with pytest.raises(Exception, match="more than four decimals"):
        R.add_batch(rows.where("status = 2").withColumn("totaldue", F.col("totaldue") + 0.00001), name, KEYS, "b")
    assert report(spark, name) == before and R.taken_batches(spark, name) == ["a"]


def test_batches_at_once_are_noticed(spark, name, monkeypatch):
    rows = header(spark)
    R.add_batch(rows.where("status = 1"), name, KEYS, "a")
    real, inside = R.with_batch, []

    def meanwhile(*args):
        if not inside:
            inside.append(1)
            R.add_batch(rows.where("status = 2"), name, KEYS, "other")
        return real(*args)

    monkeypatch.setattr(R, "with_batch", meanwhile)
    before_and_after = []
    monkeypatch.setattr(R, "current_version", lambda s, n, real=R.current_version: before_and_after.append(real(s, n)) or before_and_after[-1])
    with pytest.raises(R.ConcurrentBatch):
        R.add_batch(rows.where("status = 3"), name, KEYS, "b")
    assert sorted(R.taken_batches(spark, name)) == ["a", "other"]
    assert R.add_batch(rows.where("status = 3"), name, KEYS, "b")


def test_empty_batch_and_null_keys(spark, name):
    rows = header(spark)
    assert R.add_batch(rows.limit(0), name, KEYS, "none") and report(spark, name) == []
    odd = rows.limit(5).withColumn("territoryid", F.lit(None).cast("bigint")).withColumn("totaldue", F.lit(None).cast("double"))
    R.add_batch(odd, name, KEYS, "nulls")
    R.add_batch(odd, name, KEYS, "more nulls")
    assert R.partials(spark, name, KEYS).agg(F.sum("n")).first()[0] == 10
