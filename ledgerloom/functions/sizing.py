"""Joins to dimension tables, and keys that have to be unique."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df``, which has one row per value of ``keys``; reading a value that has several fails with that value.

    The check is part of the query: it costs an aggregation of the dimension and no job of its own.
    """
    rest = [c for c in df.columns if c not in keys]
    rows = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"), F.count("*").alias("_rows"))
    value = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    repeated = F.raise_error(F.concat(F.lit(f"{name}: more than one row for {', '.join(keys)} = "), value))
    checked = rows.select(*keys, F.when(F.col("_rows") == 1, F.col("_row")).otherwise(repeated).alias("_row"))
    return checked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def join_dimension(facts: DataFrame, dim: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Left join of ``facts`` to a dimension by (dimension column -> fact expression).

    There is no hint and no look at the data while the plan is built: adaptive execution broadcasts the dimension when
    its shuffled size turns out small, and splits the partitions of hot fact keys when it does not.
    """
    named = {f"_k_{name}": column for name, column in keys.items()}
    facts = facts.withColumns(named)
    dim = dim.withColumnsRenamed({name: f"_k_{name}" for name in keys})
    return facts.join(dim, list(named), "left").drop(*named)


#: Bits of the map that ``perhaps_listed`` broadcasts, a power of two: a million words of 64 at most, whatever the length of the list.
MAP_BITS = 1 << 26


def perhaps_listed(facts: DataFrame, key: Column, listed: DataFrame, bits: int = MAP_BITS) -> DataFrame:
    """The ``facts`` whose ``key`` may be in ``listed`` (one column): all that are, and a few others, which an exact join has to drop."""
    words, place = _map_of(listed, bits)
    return facts.join(words, place(key) & _bit_set(key, bits), "left_semi")


def surely_unlisted(facts: DataFrame, key: Column, listed: DataFrame, bits: int = MAP_BITS) -> DataFrame:
    """The ``facts`` that ``perhaps_listed`` leaves out: their ``key`` is null or certainly not in ``listed``."""
    words, place = _map_of(listed, bits)
    return facts.join(words, place(key) & _bit_set(key, bits), "left_anti")


def marked_listed(facts: DataFrame, key: Column, listed: DataFrame, name: str, bits: int = MAP_BITS) -> DataFrame:
    """All ``facts``, and whether ``perhaps_listed`` would pass them."""
    words, place = _map_of(listed, bits)
    return facts.join(words, place(key), "left").withColumn(name, F.coalesce(_bit_set(key, bits), F.lit(False))).drop("_word", "_bits")


# Masks are never null where a remainder may be, so the planner adds no filter that computes the hash once more.
def _place(value: Column, bits: int) -> Column:
    return F.xxhash64(value).bitwiseAND(F.lit(bits - 1).cast("bigint"))


def _bit(value: Column, bits: int) -> Column:
    return _place(value, bits).bitwiseAND(F.lit(63).cast("bigint")).cast("int")


def _bit_set(key: Column, bits: int) -> Column:
    return F.getbit("_bits", _bit(key, bits)) == 1


def _map_of(listed: DataFrame, bits: int) -> tuple[DataFrame, Callable[[Column], Column]]:
    """The words of a map of hashed keys, to be broadcast so that facts are not shuffled, and what a key's word is told by.

    The map's size is bounded; the longer the list is against it, the more others pass as listed.
    """
    def word(value: Column) -> Column:
        return F.when(value.isNotNull(), F.shiftright(_place(value, bits), 6))

    name = F.col(f"`{listed.columns[0]}`")
    words = listed.where(name.isNotNull()).groupBy(word(name).alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(name, bits))).alias("_bits"))
    return F.broadcast(words), lambda key: word(key) == F.col("_word")


#: Values of the hash that ``told_apart`` counts rows by: five bytes, which is what travels of a row.
PLACES = 1 << 40


def told_apart(df: DataFrame, key: list[Column | str], bits: int = MAP_BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(alone, others, counts): rows whose ``key`` no other row has, and all others with a few that are alone too.

    Where most rows are alone, what has to bring equal rows together shuffles few of them. Both have a hash of the key as
    ``_dealt``; ``counts`` (``_dealt``, ``_n``) has how many rows share it. Only hashes are shuffled; of those that several
    rows have a map is broadcast.
    """
    keyed = df.withColumn("_dealt", F.xxhash64(*key).bitwiseAND(F.lit(PLACES - 1).cast("bigint")))
    counts = keyed.groupBy("_dealt").agg(F.count("*").alias("_n"))
    shared = counts.where(F.col("_n") > 1).select(F.col("_dealt").alias("_shared"))
    return surely_unlisted(keyed, F.col("_dealt"), shared, bits), perhaps_listed(keyed, F.col("_dealt"), shared, bits), counts
