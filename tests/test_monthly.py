"""Month partitions: only the wanted ones are read."""

import pytest
from pyspark.sql import functions as F

from ledgerlens import tables as T
from ledgerlens.functions.dates import month_num
from ledgerlens.plans.loading import stage_db
from ledgerlens.sources.monthly import in_latest_months, latest_months, publish_by_month
from tests.conftest import SF_SMALL


@pytest.fixture
def name(spark):
    return f"{stage_db(spark)}.by_month"


def test_six_partitions_are_read(spark, name):
    header = T.sales_header(spark, SF_SMALL)
    assert publish_by_month(header, name, "orderdate") == header.count()
    wanted = sorted(r.m for r in header.select(month_num("orderdate").alias("m")).distinct().collect())[-6:]
    assert latest_months(spark, name, 6) == wanted[::-1]
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = in_latest_months(spark, name, 6)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [month#" in plan and f" IN ({','.join(map(str, wanted[::-1]))})" in plan
        got = df.collect()
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numPartitions").value() == 6
        assert scan.metrics().apply("numOutputRows").value() == len(got)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sorted(r.salesorderid for r in got) == sorted(
        r.salesorderid for r in header.where(month_num("orderdate").isin(wanted)).collect())


def test_rows_without_a_date_fewer_months_and_no_rows(spark, name):
    rows = spark.createDataFrame([(1, "2024-01-05"), (2, "2024-03-01"), (3, None)], "id int, day string").select("id", F.to_date("day").alias("day"))
    assert publish_by_month(rows, name, "day") == 3
    assert spark.table(name).count() == 3
    assert sorted(r.id for r in in_latest_months(spark, name, 6).collect()) == [1, 2]
    assert [r.id for r in in_latest_months(spark, name, 1).collect()] == [2]
    assert publish_by_month(rows.limit(0), name, "day") == 0
    assert in_latest_months(spark, name, 6).count() == 0
    with pytest.raises(ValueError):
        publish_by_month(rows.withColumn("month", F.lit(1)), name, "day")
