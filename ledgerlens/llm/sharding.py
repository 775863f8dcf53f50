"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table (an
offset and a skip from its name's hash).  The shards take turns, each claiming
the first free slot in its order, until the table is full: shares differ by one
slot at most, and adding or removing a shard moves few slots.  A document's hash
modulo the table size is its slot; the table, of a size fixed by parameter, is
broadcast, so placement needs one lookup and no shuffle.

Defined results: the hash is of the id, its type's text, and the document's
text, so rows with equal or null ids still spread unless their texts are equal
too; null and empty texts are the same; repeated rows go to one shard; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Shards, and slots of the table (a prime, at least 100 for each shard).
SHARDS, SLOTS = 32, 4099
#: Hexadecimal digits of the hash that make the slot.
DIGITS = 15


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of every slot."""
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table size must be a prime not below the number of shards")
    table = [-1] * slots
    orders = []
    for name in shards:
        digest = hashlib.md5(name.encode()).digest()
        orders.append([int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1])
    free = slots
    while free:
        for number, order in enumerate(orders):
            while table[order[0]] >= 0:
                order[0] = (order[0] + order[1]) % slots
            table[order[0]] = number
            free -= 1
            if not free:
                break
    return table


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    key = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("long"), F.lit(slots)).cast("int")


def table_frame(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    """(slot, shard) of every slot."""
    table = lookup_table(shards, slots)
    numbers = F.array(*map(F.lit, table))
    return spark.range(1).select(F.posexplode(numbers).alias("__slot", "__shard"))


def place(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n_shards: int = SHARDS, slots: int = SLOTS,
          slot_name: str = "slot", shard_name: str = "shard") -> DataFrame:
    """The documents with their slot and shard (columns of these names are replaced)."""
    table = table_frame(docs.sparkSession, shard_names(n_shards), slots)
    keyed = docs.withColumn("__key", slot_of(F.col(id_col), F.col(text_col), slots))
    # bounded: the table has a fixed number of slots
    found = keyed.join(F.broadcast(table), F.col("__key") == F.col("__slot"))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (slot_name, shard_name)]
    return found.select(*others, F.col("__slot").alias(slot_name), F.col("__shard").alias(shard_name))


def shard_report(docs: DataFrame, **options) -> DataFrame:
    return place(docs.select("doc_id", "text"), **options).select("doc_id", "slot", "shard")


def oracle_sql(n_shards: int = SHARDS, slots: int = SLOTS) -> str:
    """DuckDB SQL of ``shard_report`` over the table ``documents``.  The filled table is
    given as a list (its filling is tested apart); hash, slot and lookup are SQL."""
    table = ", ".join(map(str, lookup_table(shard_names(n_shards), slots)))
    return f"""
WITH filled AS (SELECT [{table}] AS shards),
keyed AS (
    SELECT doc_id, (('0x' || md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')))[1:{DIGITS}])::BIGINT % {slots}) AS slot
    FROM documents)
SELECT doc_id, slot::INTEGER AS slot, shards[slot + 1]::INTEGER AS shard FROM keyed, filled
"""
