"""Column and table name rules of the loader (metadata only, never data)."""

from __future__ import annotations

import re


def normalize_column_name(name: str) -> str:
    """Lower case, blanks removed, ``_t`` appended once for a name containing
    ``group`` and once more for a name containing ``name`` (reserved words)."""
    out = name.strip().lower()
    if "group" in out:
        out = out + "_t"
    if "name" in out:
        out = out + "_t"
    return re.sub(r"\s+", "", out)


def table_name_for(file_stem: str) -> str:
    """``Sales.SalesTerritory`` -> ``sales_salesterritory``."""
    return file_stem.replace(".", "_").lower()


def is_date_column(normalized_name: str) -> bool:
    """Columns whose name contains ``date`` are stored as timestamps."""
    return "date" in normalized_name
