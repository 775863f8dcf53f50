"""The same report over loaded and direct tables must agree; totals and rank
counts hold as properties."""

from pyspark.sql import functions as F

from ledgerlens import tables as T
from ledgerlens.functions.status import STATUS_CODES
from ledgerlens.plans import loading as L
from ledgerlens.plans import reports as R
from tests.conftest import SF_CHECK, SF_SMALL


def test_loaded_tables_give_the_same_report(spark):
    loaded, direct = L.monthly_status_loaded(spark, SF_SMALL), R.monthly_status_report(spark, SF_SMALL)
    assert loaded.count() == direct.count() > 0
    assert loaded.exceptAll(direct).count() == 0 and direct.exceptAll(loaded).count() == 0


def test_last_months_ignore_missing_dates(spark):
    header = spark.createDataFrame([("2020-01-05",), (None,), ("2020-03-01",)], "d string").select(
        F.to_timestamp("d").cast("timestamp_ntz").alias("orderdate"))
    assert R.last_months_cutoff(header, 6) == "2020-01-01"


def test_statuses_sum_to_all_orders(spark):
    rep = R.monthly_status_report(spark, SF_CHECK)
    total = rep.agg(sum(F.sum(n) for _, _, n, _ in STATUS_CODES).alias("t")).first().t
    assert total == T.read(spark, SF_CHECK, "orders").count()
    # The test data has no status 6: the column exists and is all zero.
    assert rep.agg(F.max("trcanceladas")).first()[0] == 0


def test_at_most_three_ranked_names_per_month(spark):
    top = R.top3_products_customers(spark, SF_CHECK)
    assert top.select("mes").distinct().count() == top.count()
    assert top.where(F.col("producto_n1").isNull()).count() == 0


def test_territory_file_loaded_with_name_rules(spark):
    db = L.stage_db(spark)
    res = L.load_source_files(spark, SF_SMALL, db, ["Sales.SalesOrderHeader", "Sales.SalesTerritory", "No.Such"])
    assert [r["status"] for r in res] == ["ok", "ok", "error"]
    assert [r.get("separator") for r in res] == [";", ",", None]
    terr = spark.table(f"{db}.sales_salesterritory")
    assert dict(terr.dtypes) == {"territoryid": "bigint", "name_t": "string", "group_t": "string"}
    assert terr.count() == 25


def test_runs_by_key_equal_runs_by_order_without_gaps(spark):
    # events: dense, unique sequence keys, so both readings must agree.
    by_key = {r.codigo: r.cantidad_veces_seguidos for r in R.consecutive_code_counts(spark, SF_CHECK).collect()
              if r.cantidad_veces_seguidos > 0}
    by_order = {r.codigo: r.cantidad_veces_seguidos for r in R.consecutive_codes(spark, SF_CHECK).collect()}
    assert by_key == by_order and len(by_key) == 5
