"""Which rows may teach and which are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 3 is 1; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def training_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of the rows that may teach: one row per id (the highest
    label where an id repeats), no null ids or labels."""
    return (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
            .where("doc_id is not null and label is not null")
            .where(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("label").alias("label")))
