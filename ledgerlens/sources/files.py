"""Delimited-file sink and typed reads.

Quotes inside quoted values are doubled, as other readers of such files expect;
the backslash has no meaning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Options of every delimited read and write.
FORMAT = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"'}


def write_csv(df: DataFrame, path: str, sep: str = ",", sort_by: Sequence[str] | None = None) -> None:
    """Header line, UTF-8, one folder of part files.  ``sort_by`` gives a
    globally sorted output (range-partitioned sort, part files in order)."""
    out = df.orderBy(*sort_by) if sort_by else df
    out.write.mode("overwrite").options(**FORMAT).option("sep", sep).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
             multi_line: bool = False) -> DataFrame:
    """Read with an explicit schema: no inference pass, and text such as
    ``2011-05`` stays text instead of turning into a timestamp.  A file whose
    header does not name the schema's columns in order fails.  ``multi_line``
    allows line breaks inside quotes (such a file is read by one task)."""
    return (spark.read.schema(schema).options(**FORMAT).option("sep", sep).option("multiLine", multi_line)
            .option("enforceSchema", False).option("mode", "FAILFAST").csv(path))
