"""Run a SQL script file into a target table, with a run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.sources.runlog import RunLog
from ledgerlens.sources.versions import replace_table


def read_script(path: str) -> str:
    """The statement in a script file (one statement; a trailing ';' and
    surrounding blanks are removed)."""
    with open(path, encoding="utf-8") as fh:
        text = fh.read().strip()
    while text.endswith(";"):
        text = text[:-1].rstrip()
    if not text:
        raise ValueError(f"{path}: empty script")
    return text


def run_script(spark: SparkSession, script_path: str, target: str, log_path: str | None = None,
               log_table: str | None = None, source_database: str | None = None,
               args: Mapping[str, object] | None = None) -> DataFrame:
    """Run the script against ``source_database`` (or the current one),
    replace ``target`` with the result (whole or not at all) and log each step.  Returns the
    target table (named with its database if ``source_database`` is given); the
    caller's database stays selected.

    ``args`` are the values of the script's named parameter markers (``:month``).  They
    are bound as literals of their types, never put into the text."""
    return run_scripts(spark, [(script_path, target, args)], log_path, log_table, source_database)[0]


def run_scripts(spark: SparkSession, steps: Sequence[tuple[str, str, Mapping[str, object] | None]],
                log_path: str | None = None, log_table: str | None = None,
                source_database: str | None = None) -> list[DataFrame]:
    """Run (script, target, args) steps in turn under one run of the log; a later script may
    read an earlier one's target.  The first failure ends the run: its target and those
    after it are as they were.  Returns the target tables."""
    log = RunLog(spark, log_table, log_path)
    before = spark.catalog.currentDatabase()
    out: list[DataFrame] = []
    try:
        if source_database:
            spark.catalog.setCurrentDatabase(source_database)
        for path, target, args in steps:
            status = "error"
            try:
                log.record("start", "ok", target, message=f"script={path}" + (f" args={dict(args)}" if args else ""))
                result = spark.sql(read_script(path), args=dict(args) if args else None)
                log.record("query planned", "ok", target)
                log.record("table written", "ok", target, replace_table(result, target))
                status = "ok"
                out.append(spark.table(target))
            except Exception as exc:
                log.record("failed", "error", target, message=str(exc))
                raise
            finally:
                log.record("finish", status, target)
        return out
    finally:
        if source_database:
            spark.catalog.setCurrentDatabase(before)
        log.close()
