"""Readers, writers and the catalog: delimited files, tables, scripts, JDBC, run log."""

from ledgerlens.sources.arriving import load_arriving
from ledgerlens.sources.catalog import append_table, drop_table, publish_table, table_roundtrip
from ledgerlens.sources.csv_loader import detect_separator, infer_types, load_table, load_tables
from ledgerlens.sources.files import read_csv, write_csv
from ledgerlens.sources.ledger import append_once, committed_rows
from ledgerlens.sources.monthly import in_latest_months, publish_by_month
from ledgerlens.sources.quarantine import load_split
from ledgerlens.sources.rollup import add_batch
from ledgerlens.sources.runlog import RunLog
from ledgerlens.sources.scripts import read_script, run_script, run_scripts
from ledgerlens.sources.versions import replace_table

__all__ = [
    "RunLog", "add_batch", "append_once", "append_table", "committed_rows", "detect_separator", "drop_table",
    "in_latest_months", "infer_types", "load_arriving", "load_split", "load_table", "load_tables",
    "publish_by_month", "publish_table", "read_csv", "read_script", "replace_table",
    "run_script", "run_scripts", "table_roundtrip", "write_csv",
]
