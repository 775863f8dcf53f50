"""All rows of given keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import broadcast_if_small
from ledgerlens.session import scratch_root


def key_set(keys: DataFrame, key: str) -> DataFrame:
    """Distinct keys, computed once and written to the shared checkpoint
    folder, for a key set that is checked and then used by several lookups
    (otherwise each use would recompute it from its source)."""
    scratch_root(keys.sparkSession)
    return keys.select(F.col(key)).distinct().checkpoint(eager=True)


def lookup(df: DataFrame, key: str, keys) -> DataFrame:
    """Rows of ``df`` whose ``key`` is one of ``keys``.

    ``keys`` may be one value, a short list (a filter the scan can use for
    pruning), or a DataFrame with a ``key`` column (left-semi join; broadcast
    only when its size is checked to be small).
    """
    if isinstance(keys, DataFrame):
        # a semi-join needs no distinct keys
        return df.join(broadcast_if_small(keys.select(F.col(key))), key, "left_semi")
    if isinstance(keys, Iterable) and not isinstance(keys, (str, bytes)):
        return df.where(F.col(key).isin(list(keys)))
    return df.where(F.col(key) == F.lit(keys))
