"""Scripts with named parameters, several steps under one run of the log."""

import pytest

from ledgerlens.plans.loading import stage_db
from ledgerlens.sources.scripts import run_script, run_scripts


@pytest.fixture
def db(spark):
    return stage_db(spark)


def script(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_values_are_bound_not_pasted(spark, tmp_path, db):
    path = script(tmp_path, "q.sql", "SELECT id, :word AS w FROM range(10) WHERE id >= :least;\n")
    out = run_script(spark, path, f"{db}.t", args={"least": 8, "word": "x' OR '1'='1"})
    assert sorted(map(tuple, out.collect())) == [(8, "x' OR '1'='1"), (9, "x' OR '1'='1")]
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        run_script(spark, path, f"{db}.t", args={"least": 8})
    assert spark.table(f"{db}.t").count() == 2


def test_steps_share_a_run_and_a_failure_ends_it(spark, tmp_path, db):
    first = script(tmp_path, "a.sql", "SELECT id FROM range(:n)")
    second = script(tmp_path, "b.sql", f"SELECT id * 2 AS id FROM {db}.a")
    broken = script(tmp_path, "c.sql", "SELECT no_such_column FROM range(1)")
    steps = [(first, f"{db}.a", {"n": 4}), (second, f"{db}.b", None)]
    assert [t.count() for t in run_scripts(spark, steps, log_table=f"{db}.log")] == [4, 4]
    with pytest.raises(Exception, match="no_such_column"):
        run_scripts(spark, [(first, f"{db}.a", {"n": 2}), (broken, f"{db}.b", None), (first, f"{db}.never", {"n": 1})], log_table=f"{db}.log")
    assert spark.table(f"{db}.a").count() == 2 and spark.table(f"{db}.b").count() == 4 and not spark.catalog.tableExists(f"{db}.never")
    log = spark.table(f"{db}.log").collect()
    runs = {r.run_id: [(x.step, x.status, x.rows) for x in log if x.run_id == r.run_id] for r in log}
    assert sorted(map(len, runs.values())) == [7, 8]
    assert any(("failed", "error", None) in steps and ("finish", "error", None) in steps for steps in runs.values())
