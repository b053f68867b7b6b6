"""Sharding by a permutation-filled lookup table (DataFrame functions only).

Every shard has its own permutation of the slots of a prime-sized table, and the
shards take turns claiming their most preferred slot that is still free.  Each
shard then owns size / shards slots (or one more), and when a shard comes or goes
few other slots change hands.  The table depends on the shard names alone; it is broadcast,
so placing a document is one hash and one lookup, with no shuffle.

Defined cases
  null key        placed as the text ``null``
  equal keys      one shard
  very long key   hashed whole
  ties            a slot goes to the shard whose turn it is; turns follow the order of the names given
  empty table     no rows
  extra columns   ignored by the query, kept by :func:`place`
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.llm.common import as_row, field

# The table is broadcast; its size is a parameter, never the data's.
MAX_SLOTS = 1 << 20
SHARDS = tuple(f"shard-{i:03d}" for i in range(32))
SLOTS = 4093


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], slots: int) -> list[int]:
    """Slot -> index of its shard.  Work is bounded by the parameters ``slots`` and ``shards``."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each name once")
    if slots > MAX_SLOTS or slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime between the number of shards and {MAX_SLOTS}")
    at = [_number(f"offset:{s}") % slots for s in shards]
    step = [_number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    table: list[int] = [-1] * slots
    for turn in range(slots):
        i = turn % len(shards)
        while table[at[i]] >= 0:
            at[i] = (at[i] + step[i]) % slots
        table[at[i]] = i
    return table


def slot_of(key: Column, slots: int) -> Column:
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int) -> DataFrame:
    """The lookup table as ``slot, shard``."""
    filled = F.split(F.lit(",".join(shards[i] for i in lookup_table(shards, slots))), ",")
    return spark.range(1).select(F.posexplode(filled).alias("slot", "shard")).select(F.col("slot").cast("long"), "shard")


def place(
    docs: DataFrame, key_col: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """``row`` (the whole input row), ``slot`` and ``shard``."""
    if any("," in s for s in shards):
        raise ValueError("a shard's name has no comma")
    rows = as_row(docs).withColumn("slot", slot_of(field(key_col), slots))
    return rows.join(F.broadcast(table_frame(docs.sparkSession, shards, slots)), "slot").select("row", "slot", "shard")


def write_shards(docs: DataFrame, path: str, key_col: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> None:
    """One folder per shard, written in place: a shard's rows come from many tasks, so no shard is one task's work."""
    placed = place(docs, key_col, shards, slots)
    placed.select("row.*", F.col("shard").alias("shard")).write.partitionBy("shard").parquet(path)


ORACLE = f"""
WITH RECURSIVE names AS (
  SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 3, '0') AS shard FROM range({len(SHARDS)}) t(i)),
pref AS (
  SELECT i, shard, CAST('0x' || substr(md5('offset:' || shard), 1, 15) AS BIGINT) % {SLOTS} AS o,
         CAST('0x' || substr(md5('skip:' || shard), 1, 15) AS BIGINT) % {SLOTS - 1} + 1 AS s FROM names),
perms AS (
  SELECT list(list_transform(range({SLOTS}), lambda j: (o + j * s) % {SLOTS}) ORDER BY i) AS p FROM pref),
fill AS (
  SELECT 0 AS turn, list_transform(range({SLOTS}), lambda j: -1) AS owner, CAST(NULL AS BIGINT) AS slot, CAST(NULL AS BIGINT) AS i
  UNION ALL
  SELECT turn + 1, owner[:pick] || [turn % {len(SHARDS)}] || owner[pick + 2:], pick, turn % {len(SHARDS)}
  FROM (SELECT turn, owner, list_filter(p[turn % {len(SHARDS)} + 1], lambda x: owner[x + 1] = -1)[1] AS pick
        FROM fill, perms WHERE turn < {SLOTS})),
slots AS (SELECT slot, i FROM fill WHERE slot IS NOT NULL),
placed AS (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, shard FROM placed JOIN slots USING (slot) JOIN names USING (i)
"""
