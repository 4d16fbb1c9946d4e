"""Placement of rows on shards through a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table (an offset and a step taken from its
name). The shards take turns, and at each turn a shard claims the first slot of its permutation that is still
free. Shards end up with equal numbers of slots, give or take one, and adding or removing a shard moves few
slots. A row's key is hashed to a slot and the table, whose size is fixed by its parameter, is broadcast, so
placement costs one probe and no shuffle, however uneven the sources are.

Cases: a null key is placed like the empty text; repeated rows go to the same shard and stay repeated; an empty
input gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLOTS = 65537
SHARDS = tuple(f"shard-{i:02d}" for i in range(48))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: tuple[str, ...], slots: int) -> list[int]:
    """The shard number of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if not _is_prime(slots) or slots < len(shards):
        raise ValueError("the number of slots has to be a prime not below the number of shards")
    at, step = [], []
    for name in shards:
        digest = hashlib.md5(name.encode()).hexdigest()
        at.append(int(digest[:8], 16) % slots)
        step.append(int(digest[8:16], 16) % (slots - 1) + 1)
    owner, free = [-1] * slots, slots
    while free:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(slots))


def lookup_table(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard), one row per slot."""
    names = ",".join(shards[i].replace("\\", "\\\\").replace("'", "\\'") for i in fill(shards, slots))
    if names.count(",") != slots - 1:
        raise ValueError("shard names must not hold commas")
    pairs = spark.sql(f"SELECT posexplode(split('{names}', ',')) AS (slot, shard)")
    return pairs.select(F.col("slot").cast("bigint").alias("slot"), "shard")


def place(rows: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(key, slot, shard) of every row."""
    keyed = rows.select(F.col(key), slot_of(F.col(key), slots).alias("slot"))
    return keyed.join(F.broadcast(lookup_table(rows.sparkSession, shards, slots)), "slot").select(key, "slot", "shard")


def oracle(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> str:
    names = ",".join(shards[i] for i in fill(shards, slots))
    return f"""with placed as (select string_split('{names}', ',') as owner)
select doc_id, slot, owner[slot + 1] as shard
from (select doc_id, cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 8))::bigint % {slots} as bigint) as slot from documents), placed"""
