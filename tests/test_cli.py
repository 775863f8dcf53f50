"""The command line runs a script into a table and loads files (same
process, the test session)."""

import json

from ledgerlens import cli


def test_cli_run_script_and_load(spark, tmp_path, capsys):
    spark.range(6).selectExpr("id AS secuencial", "'a' AS codigo").createOrReplaceTempView("secuenciales")
    script = tmp_path / "q.sql"
    script.write_text("SELECT codigo, count(*) AS n FROM secuenciales GROUP BY codigo;\n")
    log = tmp_path / "run.log"
    assert cli.main(["run-script", "--script", str(script), "--target", "cli_result",
                     "--log", str(log)]) == 0
    assert spark.table("cli_result").collect()[0].n == 6
    assert "table written" in log.read_text()

    (tmp_path / "Demo.Table.csv").write_text("Key;Group Name\n1;x\n2;y\n")
    capsys.readouterr()
    assert cli.main(["load", "--folder", str(tmp_path), "--names", "Demo.Table"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out[0]["table"] == "demo_table" and out[0]["rows"] == 2
    assert spark.table("demo_table").columns == ["key", "groupname_t_t"]


def test_cli_report_to_csv(spark, tmp_path, capsys):
    from tests.conftest import SF_SMALL
    out = tmp_path / "r1"
    assert cli.main(["report", "monthly_status_report", "--tables", SF_SMALL, "--csv", str(out)]) == 0
    back = spark.read.option("header", True).csv(str(out))
    assert back.columns[:2] == ["mes", "nombreterritorio"]
    from ledgerlens.plans.reports import monthly_status_report
    assert back.count() == monthly_status_report(spark, SF_SMALL).count()
