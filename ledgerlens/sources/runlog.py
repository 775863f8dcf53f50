"""Run log: one row per step (start, table loaded, error, finish).

Rows go to a plain text log file on the driver as they happen (when a path is
given, as the batch scripts do) and to a catalog table, appended in one write
per run by ``flush`` (a catalog append per step would cost a job each).
Row counts come from ``DataFrame.observe`` on the write itself, so logging
never costs a second pass over the data.
"""

from __future__ import annotations

import datetime as dt
import logging
import threading
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("step", T.StringType(), False),
    T.StructField("target", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("rows", T.LongType(), True),
    T.StructField("message", T.StringType(), True),
])


class RunLog:
    def __init__(self, spark: SparkSession, table: str | None = None, path: str | None = None,
                 run_id: str | None = None):
        self.spark = spark
        self.table = table
        self.run_id = run_id or uuid.uuid4().hex[:16]
        self.entries: list[tuple] = []
        self._pending: list[tuple] = []
        self._lock = threading.Lock()  # steps may be recorded from loader threads
        self._logger = None
        if path:
            self._logger = logging.getLogger(f"ledgerlens.run.{self.run_id}")
            self._logger.setLevel(logging.INFO)
            self._logger.propagate = False
            handler = logging.FileHandler(path, encoding="utf-8")
            handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
            self._logger.addHandler(handler)

    def record(self, step: str, status: str = "ok", target: str | None = None,
               rows: int | None = None, message: str | None = None) -> None:
        row = (self.run_id, dt.datetime.now(), step, target, status,
               None if rows is None else int(rows), message)
        with self._lock:
            self.entries.append(row)
            self._pending.append(row)
        if self._logger is not None:
            text = f"{step} target={target} status={status} rows={rows}" + (f" {message}" if message else "")
            (self._logger.error if status == "error" else self._logger.info)(text)

    def flush(self) -> None:
        """Append the steps recorded since the last flush to the log table."""
        with self._lock:
            pending, self._pending = self._pending, []
        if self.table and pending:
            (self.spark.createDataFrame(pending, LOG_SCHEMA)
             .coalesce(1).write.mode("append").saveAsTable(self.table))

    def close(self) -> None:
        self.flush()
        if self._logger is not None:
            for h in list(self._logger.handlers):
                h.close()
                self._logger.removeHandler(h)
