"""Each report's Spark SQL script equals its DataFrame form (both ways
``exceptAll``), over the report views of the check folder."""

import os

import pytest

import __spark_entry__ as E
from ledgerlens import tables as T
from ledgerlens.plans.loading import SQL_DIR
from ledgerlens.sources.scripts import read_script
from tests.conftest import SF_CHECK

SCRIPTS = sorted(f[:-4] for f in os.listdir(SQL_DIR) if f.endswith(".sql"))


def test_every_script_is_a_registered_report():
    assert set(SCRIPTS) <= set(E.queries())
    assert len(SCRIPTS) >= 7


@pytest.mark.parametrize("name", SCRIPTS)
def test_script_equals_dataframe_report(spark, name):
    T.register_views(spark, SF_CHECK)
    sql = spark.sql(read_script(os.path.join(SQL_DIR, name + ".sql")))
    df = E.queries()[name](spark, SF_CHECK)
    assert sorted(sql.columns) == sorted(df.columns)
    sql = sql.select(*df.columns)
    assert sql.count() == df.count() > 0
    assert sql.exceptAll(df).count() == 0
    assert df.exceptAll(sql).count() == 0
