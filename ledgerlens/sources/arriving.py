"""Tables over files that keep arriving, whose column types widen as needed.

Every file is summed up once: for each column, how many values are present and how
many of them are integers, numbers and booleans.  These counts add up over files, so
the type of a column over all files follows from the summaries alone.  Types form a
lattice: no value at all lies below bigint, bigint below double, double and boolean
below text.

A file's rows are stored in the segment of its own types, as a batch that counts once
(``sources.ledger``).  The table is a view that joins the segments, each column cast to
its type over all files: when a later file widens a column, the view changes in one
catalog operation, and no earlier file is read or written again.  There are as many
segments as distinct type combinations.

A load that crashed is repeated with the same call: a file's segment depends on that
file only, so what was stored already is left out.  All files have one header.  Once
a column is text, numbers of earlier files show as Spark prints them.  A column whose
name contains ``date`` is a timestamp; a value that does not parse fails the load.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.names import is_date_column, normalize_column_name
from ledgerlens.sources.csv_loader import (NULL_TOKENS, _parse_date, _typed, detect_separator, header_fields, header_line,
                                           read_options, text_schema, type_counts, type_of)
from ledgerlens.sources.ledger import append_once, committed_rows, ledger_name
from ledgerlens.sources.versions import split_name

SUMMARY_SUFFIX = "__types"
SEGMENT_MARK = "__segment_"
BATCH = "__batch"


def joined_type(a: str | None, b: str | None) -> str | None:
    """The least type above two (None: no value seen)."""
    if a is None or b is None or a == b:
        return b if a is None else a
    return "double" if {a, b} == {"bigint", "double"} else "string"


def arrived_files(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Paths below the folder, from a listing that reads no file."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
             .load(folder).select("path"))
    return sorted(r.path for r in found.collect())


def batch_of(path: str) -> str:
    return hashlib.sha256(path.encode("utf-8")).hexdigest()[:32]


def read_files(spark: SparkSession, files: list[str], sep: str, fields: list[str], null_tokens: Iterable[str]) -> DataFrame:
    """Columns of the files as text, and each row's file."""
    raw = spark.read.schema(text_schema(fields)).options(**read_options(sep, fields)).csv(files)
    tokens = list(null_tokens)
    return raw.select(*[F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string")).otherwise(F.col(f"`{c}`")).alias(c)
                        for c in raw.columns], F.col("_metadata.file_path").alias("__file"))


def summaries(rows: DataFrame, columns: list[str]) -> DataFrame:
    """file, column, n, i, d, b of every file and column, in one pass."""
    counts = rows.groupBy("__file").agg(*type_counts(columns))
    parts = [F.struct(F.lit(normalize_column_name(c)).alias("column"), *[F.col(f"{kind}{i}").alias(kind) for kind in "nidb"])
             for i, c in enumerate(columns)]
    return counts.select(F.col("__file").alias("file"), F.explode(F.array(*parts)).alias("s")).select("file", "s.*")


def file_types(spark: SparkSession, name: str) -> dict[str, dict[str, str | None]]:
    """Types of the columns of every file taken in, by file (None: no value)."""
    summary = name + SUMMARY_SUFFIX
    if not spark.catalog.tableExists(summary):
        return {}
    out: dict[str, dict[str, str | None]] = {}
    for r in committed_rows(spark, summary, BATCH).collect():
        out.setdefault(r.file, {})[r.column] = type_of(r.n, r.i, r.d, r.b) if r.n else None
    return out


def segment_of(name: str, types: dict[str, str | None]) -> str:
    text = ",".join(f"{c}={t}" for c, t in sorted(types.items()))
    return name + SEGMENT_MARK + hashlib.sha256(text.encode("utf-8")).hexdigest()[:16]


def segments(spark: SparkSession, name: str) -> list[str]:
    database, table = split_name(spark, name)
    found = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{table}{SEGMENT_MARK}*'").collect()]
    return sorted(f"{database}.{t}" for t in found if t.lower().startswith(table.lower() + SEGMENT_MARK)
                  and len(t) == len(table) + len(SEGMENT_MARK) + 16)


def show_segments(spark: SparkSession, name: str, names: list[str], types: dict[str, str | None]) -> None:
    """Point the table's view to all segments, columns cast to their joined types."""
    def column(c: str) -> str:
        kind = "timestamp_ntz" if is_date_column(c) else types.get(c) or "double"
        return f"CAST(`{c}` AS {kind}) AS `{c}`"

    parts = [f"SELECT {', '.join(map(column, names))} FROM {s} LEFT SEMI JOIN {ledger_name(s)} ON {BATCH} = batch"
             for s in segments(spark, name) if spark.catalog.tableExists(ledger_name(s))]
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS " + " UNION ALL ".join(parts))


def load_arriving(spark: SparkSession, folder: str, name: str, sep: str | None = None, suffix: str = ".csv",
                  null_tokens: Iterable[str] = NULL_TOKENS) -> dict:
    """Take in the files of the folder that the table does not hold yet.

    Returns the files taken in, their rows and the types of all columns.  One pass sums up
    the new files, one more for each type combination among them stores their rows."""
    known = file_types(spark, name)
    files = [f for f in arrived_files(spark, folder, suffix) if _plain(f) not in known]
    rows_in = 0
    if files:
        sep = sep or detect_separator(spark, files[0])
        fields = header_fields(header_line(spark, files[0]), sep)
        rows = read_files(spark, files, sep, fields, null_tokens)
        columns = [c for c in rows.columns if c != "__file"]
        names = [normalize_column_name(c) for c in columns]
        if len(set(names)) < len(names):
            raise ValueError(f"columns normalise to one name: {sorted(n for n in names if names.count(n) > 1)}")
        counted = [c for c in columns if not is_date_column(normalize_column_name(c))]
        found = summaries(rows, counted).collect()  # a row for each new file and column
        new: dict[str, dict[str, str | None]] = {f: {} for f in map(_plain, files)}
        for r in found:
            new.setdefault(_plain(r.file), {})[r.column] = type_of(r.n, r.i, r.d, r.b) if r.n else None
        groups: dict[str, list[str]] = {}
        for f in files:
            if new[_plain(f)] or not counted:
                groups.setdefault(segment_of(name, new[_plain(f)]), []).append(f)
        for segment, own in groups.items():
            types = new[_plain(own[0])]
            part = read_files(spark, own, sep, fields, null_tokens)
            typed = part.select(*[(_parse_date(F.col(f"`{c}`"), False) if is_date_column(n) else _typed(c, types.get(n) or "string")).alias(n)
                                  for c, n in zip(columns, names)],
                                F.sha2(_plain_sql(F.col("__file")), 256).substr(1, 32).alias(BATCH))
            rows_in += sum(append_once(typed, segment, BATCH).values())
        merged = {n: None for n in names}
        for types in [*known.values(), *new.values()]:
            for c, t in types.items():
                merged[c] = joined_type(merged.get(c), t)
        if groups:
            show_segments(spark, name, names, merged)
        entries = [(_plain(r.file), r.column, r.n, r.i, r.d, r.b, batch_of(_plain(r.file))) for r in found]
        if entries:
            append_once(spark.createDataFrame(entries, f"file string, column string, n long, i long, d long, b long, {BATCH} string").coalesce(1),
                        name + SUMMARY_SUFFIX, BATCH)
    schema = {f.name: f.dataType.simpleString() for f in spark.table(name).schema.fields} if spark.catalog.tableExists(name) else {}
    return {"table": name, "files": len(files), "rows": rows_in, "types": schema}


def _plain(path: str) -> str:
    """A path without the differences between listings (``file:///a`` and ``file:/a``)."""
    return re.sub("^file:/+", "file:/", path)


def _plain_sql(path):
    return F.regexp_replace(path, "^file:/+", "file:/")
