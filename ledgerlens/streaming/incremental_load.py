"""Incremental load: delimited files arriving in a folder are appended to a
catalog table with the loader's name and type rules.

The table's schema is fixed when the stream starts, from the files already
there (separator detection and type inference of the batch loader), as a
table created once and then filled.  Later files are read as text with that
header and cast to the fixed types.  The file source and the table sink keep
their progress in the checkpoint folder, so a restarted or retried stream
neither skips nor repeats a file.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.functions.names import is_date_column, normalize_column_name
from ledgerlens.session import scratch_path
from ledgerlens.sources.csv_loader import (FALSE_TOKENS, NULL_TOKENS, TRUE_TOKENS, detect_separator, header_fields,
                                           header_line, infer_types, read_options, read_text_table, text_schema)
from ledgerlens.sources.runlog import RunLog


def _cast(c: str, kind: str, tolerant: bool):
    v = F.col(f"`{c}`")
    name = normalize_column_name(c)
    if is_date_column(name):
        parsed = F.try_to_timestamp(v) if tolerant else F.to_timestamp(v)
        return parsed.cast("timestamp_ntz").alias(name)
    if kind == "string":
        return v.alias(name)
    if kind == "boolean":
        known = F.when(v.isin(TRUE_TOKENS), F.lit(True)).when(v.isin(FALSE_TOKENS), F.lit(False)).when(v.isNull(), F.lit(None))
        return (known if tolerant else known.otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), v)).cast("boolean"))).alias(name)
    return (v.try_cast(kind) if tolerant else v.cast(kind)).alias(name)


def start_incremental_load(spark: SparkSession, source_dir: str, table: str,
                           checkpoint: str | None = None, sep: str | None = None,
                           tolerant: bool = False, available_now: bool = True, multi_line: bool = False,
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops
    (run it on a schedule), otherwise it keeps watching the folder.

    A value that does not fit its column's type fails the stream; with ``tolerant``
    it becomes NULL and is counted, per column, in the metrics ``misses`` of the
    stream's progress.  A file whose header differs from the first one's fails."""
    if sep is None:
        sep = detect_separator(spark, source_dir, recursive=True)
    fields = header_fields(header_line(spark, source_dir, recursive=True), sep)
    columns = text_schema(fields).names
    if spark.catalog.tableExists(table):
        # Schema fixed at creation: later runs cast to the table's types.
        existing = {f.name: f.dataType.simpleString() for f in spark.table(table).schema.fields}
        types = {c: existing.get(normalize_column_name(c), "string") for c in columns}
    else:
        sample = read_text_table(spark, source_dir, sep, recursive=True, multi_line=multi_line)
        types = infer_types(sample, [c for c in columns if not is_date_column(normalize_column_name(c))])
    reader = spark.readStream.schema(text_schema(fields)).options(**read_options(sep, fields, True, multi_line))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir)
    cleaned = raw.select(*[F.when(F.col(f"`{c}`").isin(NULL_TOKENS), F.lit(None).cast("string"))
                           .otherwise(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    both = cleaned.select(*[_cast(c, types.get(c, "string"), tolerant) for c in columns],
                          *[F.col(f"`{c}`").alias(f"__raw{i}") for i, c in enumerate(columns)])
    names = [normalize_column_name(c) for c in columns]
    typed = both.observe("taken", F.count(F.lit(1)).alias("rows")).observe("misses", *[F.count_if(F.col(f"__raw{i}").isNotNull() & F.col(f"`{n}`").isNull()).alias(n)
                                     for i, n in enumerate(names)]).select(*[F.col(f"`{n}`") for n in names])
    writer = (typed.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{table}")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.toTable(table)


def run_incremental_load(spark: SparkSession, source_dir: str, table: str,
                         checkpoint: str, log: RunLog | None = None, **opts) -> int:
    """One scheduled run: load the files not seen yet, wait, log the rows taken in
    and the values that did not fit (tolerant), return the rows.

    Rows and misses come from the progress of every batch, which is read while the
    stream runs: the table is not counted, and another run's rows are not either.  Should
    a batch's progress be gone before it was read, the log says so."""
    query = start_incremental_load(spark, source_dir, table, checkpoint, available_now=True, **opts)
    seen: dict[int, dict] = {}
    taken: dict[int, int] = {}
    while True:
        done = query.awaitTermination(0.2)
        for p in query.recentProgress:
            metrics, number = p["observedMetrics"] or {}, int(p["batchId"])
            found, rows = metrics.get("misses"), metrics.get("taken")
            seen[number] = found.asDict() if found else seen.get(number, {})
            taken[number] = int(rows["rows"]) if rows else taken.get(number, 0)
        if done:
            break
    rows = sum(taken.values())
    misses: dict[str, int] = {}
    for batch in seen.values():
        for name, n in batch.items():
            if n:
                misses[name] = misses.get(name, 0) + int(n)
    gone = max(seen) - min(seen) + 1 - len(seen) if seen else 0
    if log is not None:
        log.record("incremental load", "ok", table, rows,
                   f"batches={len(seen)} misses={misses}" + (f" (progress of {gone} batches not seen)" if gone else ""))
    return rows
