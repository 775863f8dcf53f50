"""Exact money arithmetic.

Amounts are summed as whole numbers of 1/10000 (``bigint``), the four decimals
of the source system's money columns: such a sum does not depend on the order in
which partitions are combined and runs in generated code.  An amount with more
decimals is an error, never rounded away.  Sums are kept in two halves, so that
no total a table can hold overflows, and the per-group result is turned into a
double once, through an exact decimal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS_PER_MONEY = 10000
#: Units of the upper half of a sum, as a power of two.
HALF_BITS = 20
#: What the double of an amount with four decimals may be off a whole number of units,
#: by its size: half a unit in the last place each for the amount and for the product.
RELATIVE_ERROR = 2.0 ** -52


def money_units(col: str | Column) -> Column:
    """An amount as a whole number of 1/10000 (bigint); more decimals raise."""
    units = (F.col(col) if isinstance(col, str) else col) * UNITS_PER_MONEY
    whole = F.round(units)
    exact = F.abs(units - whole) <= F.greatest(F.abs(units) * RELATIVE_ERROR, F.lit(1e-6))
    return (F.when(units.isNull(), F.lit(None).cast("bigint")).when(exact, whole.cast("bigint"))
            .otherwise(F.raise_error(F.concat(F.lit("amount with more than four decimals: "), (units / UNITS_PER_MONEY).cast("string"))).cast("bigint")))


def sum_units(units: Column) -> Column:
    """Sum of whole units as decimal(38,0).  Upper and lower half are summed apart:
    a bigint sum of either holds 2**43 rows of any amount."""
    upper = F.sum(F.shiftright(units, HALF_BITS)).cast("decimal(20,0)")
    lower = F.sum(units.bitwiseAND(F.lit((1 << HALF_BITS) - 1).cast("bigint"))).cast("decimal(20,0)")
    return (upper * F.lit(1 << HALF_BITS).cast("decimal(7,0)") + lower).cast("decimal(38,0)")


def units_to_double(units: Column) -> Column:
    """A sum of units back to an amount: exact decimal, then double."""
    return (units.cast("decimal(38,0)") / F.lit(UNITS_PER_MONEY)).cast("double")
