"""Loads that keep good rows and set bad ones aside, in one pass over the files.

A row is rejected when it does not have the header's columns, or when a present value
does not fit its column's type: a date that does not parse, or a value other than the
type given by the caller or, if none is given, the narrowest type that all but
``MISFIT_SHARE`` of the column's values have.  Good and rejected rows are written
together, apart by a partition, as one new version (``sources.versions``); the table
shows the good ones and ``<table>__rejected`` the others: raw text, file and reasons.
Every row read is in one of the two.  A file whose header differs still fails the load.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.names import is_date_column, normalize_column_name
from ledgerlens.sources.csv_loader import (FALSE_TOKENS, NULL_TOKENS, TRUE_TOKENS, header_fields, header_line,
                                           possible_separators, read_options, text_schema, type_counts, type_of)
from ledgerlens.sources.runlog import RunLog
from ledgerlens.sources.versions import replace_table

#: The share of a column's present values that may not fit its type.
MISFIT_SHARE = 0.01
REJECTED_SUFFIX = "__rejected"
CORRUPT, FILE, REASON, APART = "__corrupt", "__file", "__reason", "__rejected"


def read_leniently(spark: SparkSession, path: str, sep: str, null_tokens: Iterable[str] = NULL_TOKENS,
                   recursive: bool = False) -> DataFrame:
    """All columns as text (null tokens as NULL), the raw text of rows that do not have the
    header's columns, and the file of every row."""
    fields = header_fields(header_line(spark, path, recursive), sep)
    schema = T.StructType([*text_schema(fields).fields, T.StructField(CORRUPT, T.StringType(), True)])
    options = {**read_options(sep, fields, recursive), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}
    raw = spark.read.schema(schema).options(**options).csv(path)
    tokens = list(null_tokens)
    return raw.select(*[F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string")).otherwise(F.col(f"`{c}`")).alias(c)
                        for c in text_schema(fields).names],
                      F.col(CORRUPT), F.col("_metadata.file_path").alias(FILE))


def best_separator(spark: SparkSession, path: str, recursive: bool = False) -> str:
    """Of the separators that split the header, the one that the fewest rows do not fit
    (the first on a tie)."""
    candidates = possible_separators(spark, path, recursive=recursive)
    if len(candidates) == 1:
        return candidates[0]
    misfits = []
    for sep in candidates:
        rows = read_leniently(spark, path, sep, recursive=recursive)
        # a data column is read along: Spark refuses queries over the raw text alone
        misfits.append(rows.agg(F.count_if(F.col(CORRUPT).isNotNull()), F.count(F.col(f"`{rows.columns[0]}`"))).first()[0])
    return candidates[misfits.index(min(misfits))]


def lenient_types(rows: DataFrame, columns: Sequence[str], misfit_share: float) -> dict[str, str]:
    if not columns:
        return {}
    stats = rows.where(F.col(CORRUPT).isNull()).agg(*type_counts(columns)).collect()[0]
    out = {}
    for i, c in enumerate(columns):
        counts = [stats[f"{kind}{i}"] for kind in "nidb"]
        out[c] = type_of(*counts, misfits=int(counts[0] * misfit_share))
    return out


def fitted(c: str, kind: str) -> Column:
    """The value as its type, NULL if it does not fit."""
    v = F.col(f"`{c}`")
    if is_date_column(normalize_column_name(c)):
        return F.try_to_timestamp(v).cast("timestamp_ntz")
    if kind == "boolean":
        return F.when(v.isin(TRUE_TOKENS), F.lit(True)).when(v.isin(FALSE_TOKENS), F.lit(False))
    return v if kind == "string" else v.try_cast(kind)


def split_rows(rows: DataFrame, types: dict[str, str], sep: str) -> DataFrame:
    """Typed columns under their normalised names, whether the row is rejected, and for
    rejected rows the raw text, file and reasons."""
    columns = [c for c in rows.columns if c not in (CORRUPT, FILE)]
    names = [normalize_column_name(c) for c in columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns normalise to one name: {sorted(n for n in names if names.count(n) > 1)}")
    typed = rows.select("*", *[fitted(c, types.get(c, "string")).alias(f"__v{i}") for i, c in enumerate(columns)])
    reasons = [F.when(F.col(f"`{c}`").isNotNull() & F.col(f"__v{i}").isNull(),
                      F.lit(f"{names[i]}: not a {'date' if is_date_column(names[i]) else types.get(c, 'string')}"))
               for i, c in enumerate(columns)]
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("row does not fit the columns")).otherwise(
        F.nullif(F.concat_ws("; ", *reasons), F.lit("")))
    bad = F.col(REASON).isNotNull()
    raw = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]), {"sep": sep}))
    return typed.withColumn(REASON, reason).select(
        *[F.when(~bad, F.col(f"__v{i}")).alias(n) for i, n in enumerate(names)],
        F.when(bad, raw).alias("__raw"), F.when(bad, F.col(FILE)).alias(FILE), REASON, bad.alias(APART))


def load_split(spark: SparkSession, path: str, table: str, sep: str | None = None, types: dict[str, str] | None = None,
               null_tokens: Iterable[str] = NULL_TOKENS, misfit_share: float = MISFIT_SHARE, recursive: bool = False,
               log: RunLog | None = None) -> dict:
    """Replace ``table`` with the good rows of the files and ``<table>__rejected`` with the
    others.  ``types`` names the type (bigint, double, boolean, string) of source columns;
    the rest are inferred.  Returns the table, its rows, the rejected rows and the separator."""
    sep = sep or best_separator(spark, path, recursive)
    rows = read_leniently(spark, path, sep, null_tokens, recursive)
    columns = [c for c in rows.columns if c not in (CORRUPT, FILE)]
    known = dict(types or {})
    open_ = [c for c in columns if c not in known and not is_date_column(normalize_column_name(c))]
    split = split_rows(rows, {**lenient_types(rows, open_, misfit_share), **known}, sep)
    counted = Observation()
    observed = split.observe(counted, F.count_if(F.col(APART)).alias("rejected"))
    names = ", ".join(f"`{normalize_column_name(c)}`" for c in columns)
    written = replace_table(observed, table, lambda w: w.partitionBy(APART), views={
        table + REJECTED_SUFFIX: f"SELECT __raw AS raw, {FILE} AS file, {REASON} AS reason FROM {{version}} WHERE {APART}",
        table: f"SELECT {names} FROM {{version}} WHERE NOT {APART}"})
    rejected = int(counted.get.get("rejected") or 0)
    if log is not None:
        log.record("load", "ok", table, written - rejected, f"sep={sep!r} rejected={rejected}")
    return {"table": table, "rows": written - rejected, "rejected": rejected, "separator": sep}
