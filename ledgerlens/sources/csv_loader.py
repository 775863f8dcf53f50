"""Delimited files -> catalog tables with normalised names and types.

Steps for one file (or folder of part files):

1. separator: the candidates that split the header line into more than one
   column are tried in order; a file whose rows do not fit under one is tried under
   the next, and rejected if none is left (any other failure is final);
2. read every column as text (no Spark inference pass);
3. null tokens (the usual spellings of "missing") become NULL;
4. types: one aggregation over all columns decides, per column, whether
   every non-NULL value is an integer, a number or a boolean; anything
   else stays text;
5. names: lower case, blanks removed, ``_t`` after names containing
   ``group`` or ``name``; a column whose name contains ``date`` becomes a
   timestamp (strict: a bad value fails the load; tolerant: it becomes NULL
   and is counted);
6. one write of a new version of the table, observed for row and bad-date counts;
   the table shows it once it is whole (``sources.versions``).

Steps 4 and 6 are the only passes over the data; both run on the executors.
Only the header line and one row of per-column flags reach the driver.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.names import is_date_column, normalize_column_name, table_name_for
from ledgerlens.sources.files import FORMAT
from ledgerlens.sources.runlog import RunLog
from ledgerlens.sources.versions import replace_table

SEPARATORS = (",", ";")

# Text read as missing by default (the pandas reader's list).
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
               "n/a", "nan", "null"]

# Text read as booleans.
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]

INTEGER_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


# How Spark names rows or headers that do not fit the columns.
MISFITS = ("MALFORMED_RECORD_IN_PARSING", "MALFORMED_CSV_RECORD", "CSV header does not conform to the schema",
           "Number of column in CSV header is not equal")


class SeparatorError(ValueError):
    pass


def is_misfit(exc: BaseException) -> bool:
    """Whether a load failed because rows or headers do not fit the columns, as they
    do under a wrong separator (and not because of a value, a file or an executor)."""
    texts, cause = [str(exc)], getattr(exc, "_origin", None)
    while cause is not None:
        texts.append(str(cause.getMessage()))
        cause = cause.getCause()
    return any(m in t for m in MISFITS for t in texts)


def header_line(spark: SparkSession, path: str, recursive: bool = False) -> str:
    rows = spark.read.option("recursiveFileLookup", recursive).text(path).limit(1).collect()
    if not rows:
        raise SeparatorError(f"{path}: empty file")
    return rows[0][0].lstrip("﻿")


def possible_separators(spark: SparkSession, path: str,
                        candidates: Sequence[str] = SEPARATORS, recursive: bool = False) -> list[str]:
    """The candidates that split the header into more than one column, in order."""
    line = header_line(spark, path, recursive)
    out = [sep for sep in candidates if len(header_fields(line, sep)) > 1]
    if not out:
        raise SeparatorError(f"{path}: one column under every separator {list(candidates)}")
    return out


def detect_separator(spark: SparkSession, path: str,
                     candidates: Sequence[str] = SEPARATORS, recursive: bool = False) -> str:
    """First candidate that splits the header into more than one column."""
    return possible_separators(spark, path, candidates, recursive)[0]


def header_fields(line: str, sep: str) -> list[str]:
    return next(csv.reader([line], delimiter=sep))


def text_schema(fields: Sequence[str]) -> T.StructType:
    """The header's columns as text; a blank name is numbered."""
    return T.StructType([T.StructField(f or f"_c{i}", T.StringType(), True) for i, f in enumerate(fields)])


def read_options(sep: str, fields: Sequence[str], recursive: bool = False, multi_line: bool = False) -> dict:
    """Reader options: malformed rows fail, and so does a file whose header does not
    name the columns of the first one in the same order (unless a name is blank)."""
    return {**FORMAT, "sep": sep, "mode": "FAILFAST", "nullValue": None, "emptyValue": "", "multiLine": multi_line,
            "enforceSchema": not all(fields), "recursiveFileLookup": recursive}


def read_text_table(spark: SparkSession, path: str, sep: str, null_tokens: Iterable[str] = NULL_TOKENS,
                    recursive: bool = False, multi_line: bool = False) -> DataFrame:
    """All columns as strings; null tokens replaced by NULL.  ``multi_line`` allows
    line breaks inside quotes; a file is then read by one task."""
    fields = header_fields(header_line(spark, path, recursive), sep)
    raw = spark.read.schema(text_schema(fields)).options(**read_options(sep, fields, recursive, multi_line)).csv(path)
    tokens = list(null_tokens)
    return raw.select(*[F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string"))
                        .otherwise(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def type_counts(columns: Sequence[str]) -> list[Column]:
    """Aggregates by column number i: present values (n), and how many of them are
    integers (i), numbers (d) and booleans (b).  Sums of them are those of all rows."""
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`")
        present = v.isNotNull()
        aggs += [
            F.count_if(present).alias(f"n{i}"),
            # The pattern is a cheap guard; a failing try_cast is costly.  The
            # cast then checks the range ('99999999999999999999' is no bigint).
            F.count_if(v.rlike(INTEGER_PATTERN) & v.try_cast("bigint").isNotNull()).alias(f"i{i}"),
            F.count_if(v.rlike(NUMBER_PATTERN) & v.try_cast("double").isNotNull()).alias(f"d{i}"),
            F.count_if(present & v.isin(TRUE_TOKENS + FALSE_TOKENS)).alias(f"b{i}"),
        ]
    return aggs


def type_of(n: int, integers: int, numbers: int, booleans: int, misfits: int = 0) -> str:
    """The narrowest type that all of ``n`` present values but ``misfits`` have; an
    all-NULL column is double (as the pandas reader has it)."""
    if n == 0:
        return "double"
    for kind, fitting in (("bigint", integers), ("double", numbers), ("boolean", booleans)):
        if n - fitting <= misfits and fitting:
            return kind
    return "string"


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """Column -> bigint / double / boolean / string from the values, in one
    aggregation over ``columns`` (default: all)."""
    columns = list(df.columns if columns is None else columns)
    if not columns:
        return {}
    stats = df.agg(*type_counts(columns)).collect()[0]
    return {c: type_of(*(stats[f"{kind}{i}"] for kind in "nidb")) for i, c in enumerate(columns)}


def _typed(c: str, kind: str) -> Column:
    v = F.col(f"`{c}`")
    if kind == "bigint":
        return v.cast("bigint")
    if kind == "double":
        return v.cast("double")
    if kind == "boolean":
        return F.when(v.isin(TRUE_TOKENS), F.lit(True)).when(v.isin(FALSE_TOKENS), F.lit(False))
    return v


def _parse_date(raw: Column, tolerant: bool) -> Column:
    return (F.try_to_timestamp(raw) if tolerant else F.to_timestamp(raw)).cast("timestamp_ntz")


def load_table(spark: SparkSession, path: str, table: str, sep: str | None = None,
               log: RunLog | None = None, **opts) -> dict:
    """Load one delimited file/folder into ``table`` (replaced).  Returns
    ``{"table", "rows", "bad_dates", "separator"}``.  Without ``sep`` the possible
    separators are tried in order; options as for ``load_with_separator``."""
    candidates = [sep] if sep else possible_separators(spark, path)
    for i, candidate in enumerate(candidates):
        try:
            return load_with_separator(spark, path, table, candidate, log=log, **opts)
        except Exception as exc:
            if i == len(candidates) - 1 or not is_misfit(exc):
                raise
            if log is not None:
                log.record("separator rejected", "ok", table, None, f"sep={candidate!r}: {exc}")
    raise SeparatorError(f"{path}: no separator")


def load_with_separator(spark: SparkSession, path: str, table: str, sep: str,
                        tolerant: bool = False, null_tokens: Iterable[str] = NULL_TOKENS,
                        partition_by: Sequence[str] | None = None, multi_line: bool = False,
                        log: RunLog | None = None) -> dict:
    text = read_text_table(spark, path, sep, null_tokens, multi_line=multi_line)
    date_src = [c for c in text.columns if is_date_column(normalize_column_name(c))]
    # Date-named columns become timestamps whatever they hold: not inferred.
    types = infer_types(text, [c for c in text.columns if c not in date_src])
    # Keep the raw date text next to the parsed value so that the write can
    # count values that were present but did not parse (tolerant mode).
    raw = text.select("*", *[F.col(f"`{c}`").alias(f"__raw{i}") for i, c in enumerate(date_src)])
    typed = raw.select(*[F.col(f"__raw{i}") for i in range(len(date_src))],
                       *_normalized_columns(text.columns, types, tolerant))
    failed = F.lit(0).cast("long")
    for i, c in enumerate(date_src):
        failed = failed + (F.col(f"__raw{i}").isNotNull()
                           & F.col(normalize_column_name(c)).isNull()).cast("long")
    obs = Observation(f"load_{table}")
    observed = (typed.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(failed).alias("bad_dates"))
                .drop(*[f"__raw{i}" for i in range(len(date_src))]))
    # The table is replaced (schema included), as drop + create does.
    replace_table(observed, table, (lambda w: w.partitionBy(*partition_by)) if partition_by else None)
    m = obs.get
    result = {"table": table, "rows": int(m.get("rows") or 0),
              "bad_dates": int(m.get("bad_dates") or 0), "separator": sep}
    if log is not None:
        log.record("load", "ok", table, result["rows"], f"sep={sep!r} bad_dates={result['bad_dates']}")
    return result


def _normalized_columns(columns: Sequence[str], types: dict[str, str], tolerant: bool) -> list[Column]:
    out, seen = [], set()
    for c in columns:
        name = normalize_column_name(c)
        if name in seen:
            raise ValueError(f"two columns normalise to {name!r}")
        seen.add(name)
        v = F.col(f"`{c}`")
        out.append((_parse_date(v, tolerant) if is_date_column(name) else _typed(c, types[c])).alias(name))
    return out


def load_tables(spark: SparkSession, folder: str, names: Sequence[str], suffix: str = ".csv",
                database: str | None = None, log: RunLog | None = None, parallel: int = 4,
                **opts) -> list[dict]:
    """Load each ``<folder>/<name><suffix>`` into table ``table_name_for(name)``
    (in ``database`` when given).  A file that fails is logged and skipped;
    the others are still loaded.  Up to ``parallel`` files are loaded at
    once (their Spark jobs run side by side); results keep the given order.
    """
    def one(name: str) -> dict:
        path = f"{folder.rstrip('/')}/{name}{suffix}"
        table = table_name_for(name)
        if database:
            table = f"{database}.{table}"
        try:
            return {"name": name, "status": "ok", **load_table(spark, path, table, log=log, **opts)}
        except Exception as exc:  # one bad file must not stop the batch
            msg = str(exc) or type(exc).__name__
            if log is not None:
                log.record("load", "error", table, None, msg)
            return {"name": name, "status": "error", "table": table, "error": msg}

    if parallel <= 1 or len(names) <= 1:
        return [one(n) for n in names]
    with ThreadPoolExecutor(max_workers=min(parallel, len(names))) as pool:
        return list(pool.map(one, names))
