"""Loading, script, catalog and lookup jobs over the test tables.

Each stages or reads whole tables, so its work grows with the data.  Staged
files go below the shared scratch folder (``spark.checkpoint.dir``); every run
has a database of its own there, so runs neither meet an earlier session's
tables nor each other's.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import tables as T
from ledgerlens.functions.dates import month_num, parse_timestamps
from ledgerlens.operators.hotkeys import spread_join
from ledgerlens.operators.joins import broadcast_if_small
from ledgerlens.operators.lookup import key_set, lookup
from ledgerlens.operators.status import merged_partials, status_columns
from ledgerlens.plans.reports import (group_vs_org, last_months_cutoff, monthly_status, monthly_status_report,
                                      status_by_month_and_territory, with_month_text, with_territory)
from ledgerlens.session import configure, scratch_path
from ledgerlens.sources.arriving import load_arriving
from ledgerlens.sources.catalog import append_table, publish_table, table_roundtrip
from ledgerlens.sources.csv_loader import load_tables
from ledgerlens.sources.files import FORMAT, read_csv, write_csv
from ledgerlens.sources.ledger import append_once, committed_rows, new_rows, write_batches
from ledgerlens.sources.monthly import in_latest_months, publish_by_month
from ledgerlens.sources.quarantine import REJECTED_SUFFIX, load_split
from ledgerlens.sources.rollup import add_batch, partials
from ledgerlens.sources.runlog import RunLog
from ledgerlens.sources.scripts import run_script, run_scripts

SQL_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "sql")

def stage_db(spark: SparkSession) -> str:
    """A new database of this run, located below the shared scratch folder."""
    name = f"ledgerlens_{uuid.uuid4().hex[:16]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name


def header_source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order header with its territory, with source-style column names and a
    remark that holds quotes, separators, a backslash or a null token."""
    header = T.header_with_territory(spark, sf_dir)
    remark = F.element_at(F.array(*map(F.lit, REMARKS)), F.pmod("salesorderid", F.lit(len(REMARKS))).cast("int") + 1)
    return header.select(
        F.col("salesorderid").alias("SalesOrderID"), F.col("customerid").alias("CustomerID"),
        F.col("territoryid").alias("TerritoryID"), F.col("orderdate").alias("OrderDate"),
        F.col("status").alias("Status"), F.col("subtotal").alias("SubTotal"),
        F.col("totaldue").alias("TotalDue"), remark.alias("Remark"))


REMARKS = ['plain', 'said "hi", left', 'a;b,c', 'NA', 'C:\\dir\\']


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str]]:
    """Source file name -> rows with source-style column names, and separator."""
    terr = T.territory(spark, sf_dir).select(
        F.col("territoryid").alias("TerritoryID"), F.col("name_t").alias("Name"), F.col("group_t").alias("Group"))
    named = {
        "Person.Person": (T.person(spark, sf_dir).select(F.col("businessentityid").alias("Business Entity ID"), F.col("title").alias("Title"),
                                                         F.col("firstname_t").alias("FirstName")), ","),
        "Production.Product": (T.product(spark, sf_dir).select(F.col("productid").alias("ProductID"), F.col("name_t").alias("Name")), ","),
        "Sales.Customer": (T.customer(spark, sf_dir).select(F.col("customerid").alias("CustomerID"), F.col("personid").alias("PersonID"),
                                                            F.col("territoryid").alias("TerritoryID")), ";"),
        "Sales.SalesOrderDetail": (T.sales_detail(spark, sf_dir).select(
            F.col("salesorderid").alias("SalesOrderID"), F.col("productid").alias("ProductID"), F.col("orderqty").alias("OrderQty")), ";"),
        "Secuenciales": (T.sequence(spark, sf_dir).select(F.col("secuencial").alias("Secuencial"), F.col("codigo").alias("Codigo")), ","),
        "Sales.SalesOrderHeader": (header_source_rows(spark, sf_dir), ";"),
        "Sales.SalesTerritory": (terr, ","),
    }
    return named


def load_source_files(spark: SparkSession, sf_dir: str, db: str, names: list[str]) -> list[dict]:
    """Stage the named tables as delimited files and load them into ``db``; a name
    without a table has no file."""
    folder = scratch_path(spark, "load")
    staged = source_tables(spark, sf_dir)
    for name in names:
        if name in staged:
            rows, sep = staged[name]
            write_csv(rows, f"{folder}/{name}.csv", sep=sep)
    log = RunLog(spark, f"{db}.run_log")
    try:
        return load_tables(spark, folder, names, database=db, log=log)
    finally:
        log.close()


def loaded(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    """The named tables after staging and loading; a failed load raises."""
    db = stage_db(spark)
    results = load_source_files(spark, sf_dir, db, names)
    failed = [r for r in results if r["status"] != "ok"]
    if failed:
        raise RuntimeError(f"load failed: {failed}")
    return {r["name"]: spark.table(r["table"]) for r in results}


def load_normalized_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage the header (';') and territory (',') files, load both with separator
    detection and the name/type rules, return the header rows with their territory's."""
    got = loaded(spark, sf_dir, ["Sales.SalesOrderHeader", "Sales.SalesTerritory"])
    return got["Sales.SalesOrderHeader"].join(got["Sales.SalesTerritory"], "territoryid", "left")


def monthly_status_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the header and territory files, then the monthly status report over the
    loaded tables (the order's own territory)."""
    got = loaded(spark, sf_dir, ["Sales.SalesOrderHeader", "Sales.SalesTerritory"])
    return monthly_status(got["Sales.SalesOrderHeader"], got["Sales.SalesTerritory"])


def load_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all eight source tables, one of which has no file and is skipped: a row
    per table with its status and the rows found in the catalog."""
    db = stage_db(spark)
    results = load_source_files(spark, sf_dir, db, ["datos_base_clientes", *source_tables(spark, sf_dir)])
    parts = []
    for r in results:
        rows = (spark.table(r["table"]).agg(F.count(F.lit(1)).alias("n_rows")) if r["status"] == "ok"
                else spark.range(1).select(F.lit(None).cast("bigint").alias("n_rows")))
        parts.append(rows.select(F.lit(r["name"]).alias("name"), F.lit(r["status"]).alias("status"), "n_rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_codes_script(spark: SparkSession, sf_dir: str) -> str:
    """Run the consecutive-codes script over the report views into a table of this
    run; returns the database.  The views live in a session of their own."""
    own = configure(spark.newSession())
    db = stage_db(spark)
    T.register_views(own, sf_dir)
    run_script(own, os.path.join(SQL_DIR, "consecutive_code_counts.sql"), f"{db}.resultado_script", log_table=f"{db}.run_log")
    return db


def script_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run a script file into a result table, logging each step; return the table."""
    return spark.table(f"{run_codes_script(spark, sf_dir)}.resultado_script")


def script_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The steps that the run log of such a run holds, in order."""
    log = spark.table(f"{run_codes_script(spark, sf_dir)}.run_log")
    return log.select("step", "status", F.col("rows").alias("n_rows"), F.element_at(F.split("target", r"\."), -1).alias("target"))


def script_with_month_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One script with parameters, run for the first and for the last month of the orders
    into a table each, under one run of the log; both tables' rows."""
    own = configure(spark.newSession())
    db = stage_db(spark)
    T.register_views(own, sf_dir)
    months = T.sales_header(spark, sf_dir).agg(F.min(month_num("orderdate")), F.max(month_num("orderdate"))).first()
    script = os.path.join(SQL_DIR, "parameters", "month_by_territory.sql")
    run_scripts(own, [(script, f"{db}.month_{m}", {"month": m, "status": 5}) for m in sorted(set(months))], log_table=f"{db}.run_log")
    out = None
    for m in sorted(set(months)):
        table = spark.table(f"{db}.month_{m}")
        out = table if out is None else out.unionByName(table)
    return out


def customer_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer table -> session catalog (dropped first) -> SELECT *."""
    return table_roundtrip(spark, T.read(spark, sf_dir, "customer"), "customer_copy", stage_db(spark))


def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the customers to a new table in two parts, the second with its columns
    in another order; return the table."""
    rows = T.read(spark, sf_dir, "customer")
    name = f"{stage_db(spark)}.customer_parts"
    append_table(rows.where("c_custkey % 2 = 0"), name)
    append_table(rows.where("c_custkey % 2 <> 0").select(*reversed(rows.columns)), name)
    return spark.table(name)


def replace_after_failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the header file, then the same file with a bad date in its last order, which
    fails while the table is being written: the first load's rows are all there.  A row
    per order, with how many of the two loads succeeded."""
    db = stage_db(spark)
    first, second = scratch_path(spark, "load"), scratch_path(spark, "load")
    header = header_source_rows(spark, sf_dir).drop("Remark")
    last = header.agg(F.max("SalesOrderID")).first()[0]
    write_csv(header, f"{first}/Sales.SalesOrderHeader.csv", sep=";")
    date = F.date_format("OrderDate", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    write_csv(header.withColumn("OrderDate", F.when(F.col("SalesOrderID") == last, F.lit("no date")).otherwise(date)),
              f"{second}/Sales.SalesOrderHeader.csv", sep=";")
    results = [load_tables(spark, folder, ["Sales.SalesOrderHeader"], database=db)[0] for folder in (first, second)]
    succeeded = sum(r["status"] == "ok" for r in results)
    return spark.table(results[0]["table"]).withColumn("loads_ok", F.lit(succeeded).cast("bigint"))


def append_batches_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders sent in batches of a year, some of them twice: the first half, all of them,
    and all again after the last year's rows had been written without being committed.
    The committed rows, with their batch."""
    orders = T.read(spark, sf_dir, "orders").withColumn("batch_id", F.year("o_orderdate").cast("string"))
    name = f"{stage_db(spark)}.orders_by_batch"
    middle, last = orders.agg(F.percentile_approx(F.year("o_orderdate"), 0.5), F.max(F.year("o_orderdate"))).first()
    append_once(orders.where(F.year("o_orderdate") <= middle), name)
    append_once(orders.where(F.year("o_orderdate") < last), name)
    write_batches(new_rows(orders, name, "batch_id"), name, "batch_id")  # a run that ended before its commit
    append_once(orders, name)
    append_once(orders, name)
    return committed_rows(spark, name)


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header file in which some rows have a separator too many, a bad date or a bad
    amount: each order once, whether it was loaded and, if not, why."""
    header = header_source_rows(spark, sf_dir)
    key = F.col("SalesOrderID") % 50
    folder = scratch_path(spark, "load")
    rows = header.select(
        "SalesOrderID", "CustomerID", "TerritoryID",
        F.when(key == 1, F.lit("not known")).otherwise(F.date_format("OrderDate", "yyyy-MM-dd HH:mm:ss")).alias("OrderDate"), "Status",
        F.when(key.isin(1, 2), F.lit("1,5")).otherwise(F.col("SubTotal").cast("string")).alias("SubTotal"),
        F.when(key == 0, F.lit("one;more")).otherwise(F.lit("plain")).alias("Remark"))
    # as a program writes that does not quote
    rows.write.options(**{**FORMAT, "sep": ";", "quote": "\u0000"}).csv(f"{folder}/header.csv")
    table = f"{stage_db(spark)}.header"
    load_split(spark, f"{folder}/header.csv", table, types={"SubTotal": "double"})
    kept = spark.table(table).select("salesorderid", F.lit(True).alias("kept"), F.lit(None).cast("string").alias("reason"))
    rejected = spark.table(table + REJECTED_SUFFIX).select(
        F.split("raw", ";")[0].cast("bigint").alias("salesorderid"), F.lit(False).alias("kept"), "reason")
    return kept.unionByName(rejected)


def types_over_arriving_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arriving in two files' worth, the first with whole amounts and numbers as
    codes, the second with cents and text; nothing new arrives before the third load.
    The table holds both, amounts as double and codes as text."""
    header = header_source_rows(spark, sf_dir).select("SalesOrderID", "OrderDate", "SubTotal", "Status")
    odd = F.col("SalesOrderID") % 2 == 1
    folder, table = scratch_path(spark, "inbox"), f"{stage_db(spark)}.arriving_orders"
    write_csv(header.where(~odd).select("SalesOrderID", "OrderDate", F.floor("SubTotal").alias("SubTotal"), F.col("Status").alias("Code")),
              f"{folder}/first", sep=";")
    load_arriving(spark, folder, table)
    write_csv(header.where(odd).select("SalesOrderID", "OrderDate", "SubTotal", F.concat(F.lit("S"), "Status").alias("Code")),
              f"{folder}/second", sep=";")
    load_arriving(spark, folder, table)
    load_arriving(spark, folder, table)
    return spark.table(table)


def monthly_status_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly status report from a rollup that took in the header in three loads,
    the last of them sent twice; each load reads its own rows only."""
    staged, rollup = scratch_path(spark, "header"), f"{stage_db(spark)}.status_rollup"
    header = T.header_with_territory(spark, sf_dir)
    header.withColumn("load", F.pmod("salesorderid", F.lit(3)).cast("int")).write.partitionBy("load").parquet(staged)
    keys = ["_m", "territoryid"]
    for load in (0, 1, 2, 2):
        rows = spark.read.schema(header.schema).parquet(f"{staged}/load={load}").withColumn("_m", month_num("orderdate"))
        add_batch(rows, rollup, keys, f"load {load}")
    named = partials(spark, rollup, keys).join(broadcast_if_small(T.territory(spark, sf_dir)), "territoryid").withColumnRenamed("name_t", "nombreterritorio")
    keys = ["_m", "nombreterritorio"]
    return with_month_text(status_columns(merged_partials(named, keys), keys))


def group_vs_org_avg_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header published by month, then the report of the last six months over it:
    only their partitions are read."""
    name = f"{stage_db(spark)}.header_by_month"
    publish_by_month(T.header_with_territory(spark, sf_dir), name, "orderdate")
    return group_vs_org(with_territory(in_latest_months(spark, name, 6), T.territory(spark, sf_dir)))


def monthly_status_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly status report over joins that spread hot keys: orders with their
    customers, then with the few territories (every one of which is hot)."""
    customers = T.customer(spark, sf_dir).select("customerid", "territoryid")
    placed = spread_join(T.sales_header(spark, sf_dir), customers, ["customerid"])
    named = spread_join(placed, T.territory(spark, sf_dir).select("territoryid", "name_t"), ["territoryid"])
    return status_by_month_and_territory(named)


def parsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose date went through text and back, with the key as text."""
    orders = T.sales_header(spark, sf_dir).select(
        F.col("salesorderid").cast("string").alias("order_text"), F.date_format("orderdate", "yyyy-MM-dd HH:mm:ss").alias("orderdate"))
    return parse_timestamps(orders, ["orderdate"])


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly status report -> CSV (header, sorted by month and territory)
    -> read back with its explicit schema."""
    report = monthly_status_report(spark, sf_dir)
    path = scratch_path(spark, "report-csv")
    write_csv(report, path, sort_by=["mes", "nombreterritorio"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in report.schema.fields)
    return read_csv(spark, path, schema)


def filter_sort_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-equal and later-than filter, highest value first (ties: event id): events
    other than 'view' after 2024-01-15 (both predicates reach the Parquet scan)."""
    ev = T.read(spark, sf_dir, "events")
    return (ev.where((F.col("event_type") != "view")
                     & (F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")))
            .select("event_id", "event_type", F.to_date("ts").alias("event_date"), "value")
            .orderBy(F.col("value").desc(), "event_id"))


def customer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the customers keyed by c_custkey, then look up every customer
    who ordered in the latest month: their customer row and all their
    orders."""
    name = f"{stage_db(spark)}.customer_by_key"
    publish_table(T.read(spark, sf_dir, "customer"), name, "c_custkey")
    published = spark.table(name)
    orders = T.read(spark, sf_dir, "orders")
    cutoff = last_months_cutoff(T.sales_header(spark, sf_dir), 1)
    recent = orders.where(F.col("o_orderdate") >= F.lit(cutoff).cast("timestamp_ntz"))
    keys = key_set(recent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    found = lookup(published, "c_custkey", keys)
    # The same key set filters the orders before they are shuffled for the
    # join, so only the looked-up customers' orders move.
    their_orders = lookup(orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", keys)
    return (found.join(their_orders, "c_custkey", "inner")
            .select(*published.columns, "o_orderkey", "o_orderdate", "o_totalprice",
                    "o_orderstatus", "o_orderpriority"))


def incremental_header_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header file arrives in two batches (orders before, then from, the
    middle month); each batch is taken in by one available-now run of the
    streaming loader.  Returns the loaded table (all orders, each once)."""
    from ledgerlens.streaming import run_incremental_load

    db = stage_db(spark)
    table = f"{db}.sales_salesorderheader_stream"
    inbox = scratch_path(spark, "inbox")
    checkpoint = scratch_path(spark, "inbox-checkpoint")
    # Middle month of the orders (month index median, one value).
    mi = T.sales_header(spark, sf_dir).agg(F.percentile_approx(F.year("orderdate") * 12 + F.month("orderdate") - 1, 0.5)).first()[0]
    cut = F.lit(f"{mi // 12:04d}-{mi % 12 + 1:02d}-01").cast("timestamp_ntz")
    staged = scratch_path(spark, "header")
    header_source_rows(spark, sf_dir).drop("Remark").write.parquet(staged)
    rows = spark.read.parquet(staged)
    log = RunLog(spark, f"{db}.run_log")
    write_csv(rows.where(F.col("OrderDate") < cut), f"{inbox}/batch1", sep=";")
    run_incremental_load(spark, inbox, table, checkpoint, log=log)
    write_csv(rows.where(~(F.col("OrderDate") < cut) | F.col("OrderDate").isNull()), f"{inbox}/batch2", sep=";")
    run_incremental_load(spark, inbox, table, checkpoint, log=log)
    log.close()
    return spark.table(table)
