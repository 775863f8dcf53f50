"""Repeatable append: a batch counts once, also after a crash."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans.loading import stage_db
from ledgerlens.sources import ledger as L


@pytest.fixture
def name(spark):
    return f"{stage_db(spark)}.batches"


def batch(spark, b, lo, hi):
    return spark.range(lo, hi).withColumn("batch_id", F.lit(b))


def got(spark, name):
    return sorted((r.batch_id, r.id) for r in L.committed_rows(spark, name).collect())


def test_batches_count_once(spark, name):
    assert L.append_once(batch(spark, "a", 0, 3), name) == {"a": 3}
    assert L.append_once(batch(spark, "a", 0, 3), name) == {}
    both = batch(spark, "b", 5, 7).unionByName(batch(spark, "a", 100, 200))  # 'a' is not looked at again
    assert L.append_once(both, name) == {"b": 2}
    assert got(spark, name) == [("a", 0), ("a", 1), ("a", 2), ("b", 5), ("b", 6)]


def test_crash_between_write_and_ledger(spark, name, monkeypatch):
    L.append_once(batch(spark, "a", 0, 2), name)
    with monkeypatch.context() as m:
        m.setattr(L, "commit_written", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            L.append_once(batch(spark, "b", 10, 15), name)
    assert spark.table(name).count() == 7 and got(spark, name) == [("a", 0), ("a", 1)]
    assert L.append_once(batch(spark, "b", 10, 13), name) == {"b": 3}  # the partition is replaced, not added to
    assert got(spark, name) == [("a", 0), ("a", 1), ("b", 10), ("b", 11), ("b", 12)]


def test_failed_write_commits_nothing(spark, name):
    L.append_once(batch(spark, "a", 0, 2), name)
    bad = batch(spark, "b", 0, 50).withColumn("id", F.when(F.col("id") == 49, F.raise_error(F.lit("lost midway")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost midway"):
        L.append_once(bad, name)
    assert got(spark, name) == [("a", 0), ("a", 1)]


def test_rows_without_a_batch_and_empty_appends(spark, name):
    with pytest.raises(Exception, match="a row without batch_id"):
        L.append_once(spark.range(2).withColumn("batch_id", F.lit(None).cast("string")), name)
    assert L.append_once(batch(spark, "a", 0, 0), name) == {}
    assert L.committed_rows(spark, name).count() == 0
    assert L.append_once(batch(spark, 7, 0, 1).select("batch_id", "id"), name) == {"7": 1}
    assert got(spark, name) == [("7", 0)]
