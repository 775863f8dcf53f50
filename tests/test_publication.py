"""Published tables: buckets from measured bytes, Bloom filters of the key."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.lookup import lookup
from ledgerlens.plans.loading import stage_db
from ledgerlens.sources.catalog import measured_buckets, publish_table


@pytest.fixture
def name(spark):
    return f"{stage_db(spark)}.published"


def scanned(spark, table, key):
    """Rows that the scan hands on for a key, without the column indexes' help."""
    files = spark.table(table).inputFiles()
    df = lookup(spark.read.option("parquet.filter.columnindex.enabled", "false").parquet(*files), "k", key)
    found = df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return len(found), scan.metrics().apply("numOutputRows").value()


def test_buckets_follow_the_bytes(spark):
    rows = spark.range(1000).withColumn("v", F.lit("x" * 100))
    size = rows.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    assert measured_buckets(rows) == (1, 1000)
    assert measured_buckets(rows, size // 5)[0] == 8 and measured_buckets(rows, size)[0] == 1 and measured_buckets(rows, size - 1)[0] == 2
    assert measured_buckets(rows.limit(0)) == (1, 1)


def test_bloom_filter_skips_row_groups(spark, name):
    rows = spark.range(0, 200_000, 2).withColumnRenamed("id", "k").withColumn("v", F.xxhash64("k"))
    assert publish_table(rows, name, "k", buckets=2) == 2
    read = scanned(spark, name, 100_000)  # present: its row group is read
    assert read[0] == 1 and 0 < read[1] <= 60_000
    absent = [scanned(spark, name, k) for k in range(50_001, 50_041, 2)]  # within the range of every file
    assert all(n == 0 for n, _ in absent) and sum(m == 0 for _, m in absent) >= 15
    publish_table(rows, name, "k", buckets=2, bloom=False)
    assert all(scanned(spark, name, k) != (0, 0) for k in (50_001, 50_003))


def test_failed_publication_keeps_the_table(spark, name):
    publish_table(spark.range(10).withColumnRenamed("id", "k"), name, "k")
    bad = spark.range(20).select(F.when(F.col("id") == 19, F.raise_error(F.lit("lost midway")).cast("long")).otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception, match="lost midway"):
        publish_table(bad, name, "k", buckets=2, bloom=False)
    assert spark.table(name).count() == 10
