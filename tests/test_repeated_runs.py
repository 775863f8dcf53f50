"""The queries that write to the catalog, in plain sessions that share one
warehouse: one after the other, and two at once in one session."""

import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor

import __spark_entry__ as E
from tests.conftest import ROOT, SF_SMALL

WRITERS = ["load_normalized_table", "load_all_tables", "script_to_table", "script_run_log", "append_rows", "table_roundtrip",
           "customer_lookup", "incremental_load"]

PLAIN = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as E
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.warehouse.dir", sys.argv[3]).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
for name in sys.argv[4:]:
    print(name, E.queries()[name](spark, sys.argv[2]).count())
"""


def test_two_sessions_over_one_warehouse(tmp_path):
    outs = []
    for _ in range(2):
        run = subprocess.run([sys.executable, "-c", PLAIN, ROOT, SF_SMALL, str(tmp_path / "warehouse"), *WRITERS],
                             cwd=tmp_path, capture_output=True, text=True, timeout=300)
        assert run.returncode == 0, run.stderr[-2000:]
        outs.append([x for x in run.stdout.splitlines() if x.split(" ")[0] in WRITERS])
    assert outs[0] == outs[1] and len(outs[0]) == len(WRITERS)


def test_two_at_once_in_one_session(spark):
    names = [n for n in WRITERS for _ in range(2)]
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda n: E.queries()[n](spark, SF_SMALL).count(), names))
    assert counts[::2] == counts[1::2] and min(counts) > 0
