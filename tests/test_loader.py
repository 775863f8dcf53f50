"""Loader: separator choice, name rules, null tokens, types, bad dates,
batch with a failing file, script runner and its log."""

import os

import pytest

from ledgerlens.functions.names import normalize_column_name, table_name_for
from ledgerlens.sources.csv_loader import (SeparatorError, detect_separator, infer_types, load_table,
                                           load_tables, read_text_table)
from ledgerlens.sources.runlog import RunLog
from ledgerlens.sources.scripts import read_script, run_script


def write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return str(path)


def test_name_rules():
    assert normalize_column_name("GroupName") == "groupname_t_t"
    assert normalize_column_name("Order Date") == "orderdate"
    assert normalize_column_name("Name") == "name_t"
    assert normalize_column_name("Group") == "group_t"
    assert normalize_column_name("Updated") == "updated"
    assert table_name_for("Sales.SalesTerritory") == "sales_salesterritory"


def test_separator_choice(spark, tmp_path):
    semi = write(tmp_path / "a.csv", "A;B;C\n1;2;3\n")
    comma = write(tmp_path / "b.csv", "A,B\n1,2\n")
    single = write(tmp_path / "c.csv", "A\n1\n")
    assert detect_separator(spark, semi) == ";"
    assert detect_separator(spark, comma) == ","
    with pytest.raises(SeparatorError):
        detect_separator(spark, single)


def test_null_tokens_and_types(spark, tmp_path):
    p = write(tmp_path / "t.csv",
              "id;amount;flag;label;empty\n1;1.5;True;x;\n2;NULL;false;NA;\n3;NA;TRUE;y;\n;2;False;z;\n")
    text = read_text_table(spark, p, ";")
    types = infer_types(text)
    assert types == {"id": "bigint", "amount": "double", "flag": "boolean", "label": "string",
                     "empty": "double"}


def test_load_table_rules_and_bad_dates(spark, tmp_path):
    p = write(tmp_path / "Sales.Thing.csv",
              "Thing ID;GroupName;Order Date;Updated;Total\n"
              "1;North;2020-01-02 00:00:00.000;2020-02-01;10.5\n"
              "2;South;not a date;2020-02-02;NULL\n")
    res = load_table(spark, p, "thing_tolerant", tolerant=True)
    assert res["rows"] == 2 and res["bad_dates"] == 1 and res["separator"] == ";"
    df = spark.table("thing_tolerant")
    assert df.columns == ["thingid", "groupname_t_t", "orderdate", "updated", "total"]
    assert dict(df.dtypes) == {"thingid": "bigint", "groupname_t_t": "string", "orderdate": "timestamp_ntz",
                               "updated": "timestamp_ntz", "total": "double"}
    rows = sorted(df.collect())
    assert rows[1].orderdate is None and rows[1].total is None
    with pytest.raises(Exception):
        load_table(spark, p, "thing_strict", tolerant=False)


def test_batch_load_skips_failing_file(spark, tmp_path):
    write(tmp_path / "Good.One.csv", "A,B\n1,2\n")
    write(tmp_path / "Bad.One.csv", "A\n1\n")
    log = RunLog(spark, path=str(tmp_path / "load.log"))
    res = load_tables(spark, str(tmp_path), ["Bad.One", "Good.One"], log=log)
    log.close()
    assert [r["status"] for r in res] == ["error", "ok"]
    assert spark.table("good_one").count() == 1
    text = open(tmp_path / "load.log").read()
    assert "ERROR" in text and "good_one" in text


def test_run_script_writes_table_and_log(spark, tmp_path):
    spark.range(10).selectExpr("id AS secuencial", "CASE WHEN id < 5 THEN 'a' ELSE 'b' END AS codigo") \
        .createOrReplaceTempView("secuenciales")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = os.path.join(here, "ledgerlens", "sql", "consecutive_code_counts.sql")
    log_path = str(tmp_path / "run.log")
    out = run_script(spark, script, "script_result", log_path=log_path, log_table="script_log")
    got = {r.codigo: r.cantidad_veces_seguidos for r in out.collect()}
    assert got == {"a": 3, "b": 3}
    lines = open(log_path).read().splitlines()
    assert any("table written" in ln and "rows=2" in ln for ln in lines)
    assert spark.table("script_log").where("status = 'ok'").count() >= 3
    assert read_script(write(tmp_path / "s.sql", "select 1;;\n")) == "select 1"


def test_run_script_failure_is_logged(spark, tmp_path):
    bad = write(tmp_path / "bad.sql", "SELECT no_such_column FROM no_such_table")
    log_path = str(tmp_path / "fail.log")
    with pytest.raises(Exception):
        run_script(spark, bad, "never_written", log_path=log_path)
    text = open(log_path).read()
    assert "failed" in text and "finish target=never_written status=error" in text
    assert not spark.catalog.tableExists("never_written")


def test_quoted_values(spark, tmp_path):
    p = write(tmp_path / "Quoted.csv", 'id;a\n1;"say ""hi"" bob"\n2;"say ""hi""; bob"\n3;"two\nlines"\n4;"C:\\dir\\"\n')
    load_table(spark, p, "quoted_values", multi_line=True)
    rows = [r.a for r in spark.table("quoted_values").orderBy("id").collect()]
    assert rows == ['say "hi" bob', 'say "hi"; bob', "two\nlines", "C:\\dir\\"]


def test_next_separator_is_tried(spark, tmp_path):
    # the header splits under ',' too, but the rows do not
    p = write(tmp_path / "Fall.csv", "id;name, first;x\n1;ann;2\n2;bob;3\n")
    log = RunLog(spark)
    res = load_table(spark, p, "fall_through", log=log)
    assert res["separator"] == ";" and res["rows"] == 2
    assert spark.table("fall_through").columns == ["id", "name,first_t", "x"]
    assert any(e[2] == "separator rejected" for e in log.entries)


def test_part_files_with_another_header_fail(spark, tmp_path):
    folder = tmp_path / "Parts.csv"
    folder.mkdir()
    write(folder / "a.csv", "Id;Qty\n1;10\n")
    write(folder / "b.csv", "Qty;Id\n77;2\n")
    with pytest.raises(Exception):
        load_table(spark, str(folder), "parts_table")


def test_error_text_is_whole(spark, tmp_path):
    write(tmp_path / "Bad.Dates.csv", "A,Some Date\n1,no date at all\n")
    (res,) = load_tables(spark, str(tmp_path), ["Bad.Dates"])
    assert res["status"] == "error" and "no date at all" in res["error"]
