"""Column-level helpers: month keys, exact money sums, status codes, names."""

from ledgerlens.functions.dates import days_between, month_num, month_text, parse_timestamps
from ledgerlens.functions.money import money_units, sum_units, units_to_double
from ledgerlens.functions.names import normalize_column_name, table_name_for
from ledgerlens.functions.status import STATUS_CODES

__all__ = [
    "STATUS_CODES", "days_between", "money_units", "month_num", "month_text", "normalize_column_name",
    "parse_timestamps", "sum_units", "table_name_for", "units_to_double",
]
