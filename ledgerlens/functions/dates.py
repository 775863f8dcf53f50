"""Date helpers.  Month keys are text ``yyyy-MM`` as in the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole days from ``earlier`` to ``later`` as bigint (NULL if either is NULL)."""
    a = F.col(later) if isinstance(later, str) else later
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    return F.datediff(a, b).cast("bigint")


def parse_timestamps(df, columns, tolerant: bool = False):
    """Parse the given text columns to timestamps in place (strict: a bad
    value raises under ANSI; tolerant: it becomes NULL)."""
    parse = F.try_to_timestamp if tolerant else F.to_timestamp
    return df.withColumns({c: parse(F.col(c)).cast("timestamp_ntz") for c in columns})


def month_num(col: str | Column) -> Column:
    """Month as the integer yyyymm: a fixed-width key that groups, sorts and
    hashes faster than text.  Reports group and partition by it and format
    the text key once per output row with ``month_text``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.year(c) * 100 + F.month(c)


def month_text(num: str | Column) -> Column:
    """``yyyy-MM`` text of a ``month_num`` value."""
    m = F.col(num) if isinstance(num, str) else num
    return F.format_string("%04d-%02d", (m / 100).cast("int"), (m % 100).cast("int"))
