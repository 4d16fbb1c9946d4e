"""ERP stock: prepack join, one row per size, UPC backfill, allocation of stock to sizes, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.money import half_up_ratio
from ledgerloom.functions.sizing import join_dimension, unique
from ledgerloom.functions.text import fold, grouped, nonzero_number, one_of, same
from ledgerloom.params import EXCLUDED_CLASS, LOOSE_PACKS, PREPACK_SIZE, PREPACK_SLOTS

STOCK_COLUMNS = [
    "division", "div_name", "sub_div", "sub_div_desc", "warehouse", "warehouse_name", "season", "style", "color", "pack_dim",
    "size", "upc", "carton_qty", "avail_in_stock", "in_transit", "wip", "cost", "sku200",
]
PREPACK_COLUMNS = ["size_scale_1", "size_scale_2", "size_scale_3", "prepack_desc", "total_units"]
SIZE_COLUMNS = ["type", "size_detail", "qty"]
NO_SIZE = "NO SIZE"


def prepack_join(inventory: DataFrame, prepack: DataFrame) -> DataFrame:
    """Stock with the prepack of its division, pack code and season letter, if there is one."""
    slots = [f"{c}_{i}" for i in range(1, PREPACK_SLOTS + 1) for c in ("size", "qty")]
    packs = prepack.select(
        "division", fold("prepack_code").alias("pack_key"), fold("season").alias("season_key"),
        F.col("season").alias("season_1"), "prepack_code", *PREPACK_COLUMNS, *slots,
    )
    packs = unique(packs, ["division", "pack_key", "season_key"], "prepacks")
    blanked = {c: F.coalesce(F.col(c), F.lit("")) for c in ("color", "size", "sku200")}
    stock = inventory.select(*STOCK_COLUMNS).withColumns(blanked)
    keys = {"division": F.col("division"), "pack_key": fold("pack_dim"), "season_key": fold(F.left("season", F.lit(1)))}
    return join_dimension(stock, packs, keys)


def prepack_size_explode(expanded: DataFrame, max_slot: int = PREPACK_SLOTS) -> DataFrame:
    """One row per size slot of every stock row that has a prepack, in one pass."""
    slots = F.array(*[
        F.struct(F.lit(f"SIZE_{i}").alias("type"), F.col(f"size_{i}").alias("size_detail"), F.col(f"qty_{i}").alias("qty"))
        for i in range(1, max_slot + 1)
    ])
    return expanded.where(F.col("total_units").isNotNull()).select(*STOCK_COLUMNS, *PREPACK_COLUMNS, F.inline(slots))


def loose_stock_rows(expanded: DataFrame) -> DataFrame:
    """Stock without a prepack in the packs that are sold loose: its own size, quantity 1."""
    loose = expanded.where(F.col("total_units").isNull() & one_of("pack_dim", LOOSE_PACKS))
    return loose.select(
        *STOCK_COLUMNS, *PREPACK_COLUMNS, F.lit(NO_SIZE).alias("type"), F.col("size").alias("size_detail"), F.lit(1).alias("qty")
    )


def stock_by_size(inventory: DataFrame, prepack: DataFrame, max_slot: int = PREPACK_SLOTS) -> DataFrame:
    """Size slots and loose rows in one pass over the joined stock."""
    expanded = prepack_join(inventory, prepack)
    size = F.struct(F.lit(NO_SIZE).alias("type"), F.col("size").alias("size_detail"), F.lit(1).alias("qty"))
    slots = F.array(*[
        F.struct(F.lit(f"SIZE_{i}").alias("type"), F.col(f"size_{i}").alias("size_detail"), F.col(f"qty_{i}").alias("qty"))
        for i in range(1, max_slot + 1)
    ])
    rows = F.when(F.col("total_units").isNotNull(), slots).when(one_of("pack_dim", LOOSE_PACKS), F.array(size))
    return expanded.select(*STOCK_COLUMNS, *PREPACK_COLUMNS, F.inline(rows))


def size_upc_backfill(sized: DataFrame) -> DataFrame:
    """UPCs of packed rows are reset to 0 and taken from a row of the same style, color and size.

    Of several candidates the smallest UPC is used. The candidates are one row per key, so the join
    never multiplies rows.
    """
    reset = sized.withColumn("upc", F.when(~one_of("pack_dim", LOOSE_PACKS), F.lit("0")).otherwise(F.col("upc")))
    keys = ("style", "color", "size_detail")
    known = reset.where(nonzero_number("upc")).groupBy(*[fold(k).alias(f"_{k}") for k in keys]).agg(F.min("upc").alias("known_upc"))
    settled = F.col("upc").isNull() | nonzero_number("upc") | F.col("size_detail").isNull()
    # Rows that keep their UPC have no key to look up; a key of their own spreads them over the tasks.
    own = F.concat(F.lit("\u0000"), F.xxhash64(*sized.columns).cast("string"))
    lookup = [F.when(settled, own).otherwise(fold("style")) == F.col("_style")]
    lookup += [fold(k) == F.col(f"_{k}") for k in ("color", "size_detail")]
    joined = reset.join(known, lookup, "left")
    return joined.withColumn("upc", F.coalesce("known_upc", "upc")).select(*sized.columns)


def prepack_prune(sized: DataFrame) -> DataFrame:
    """Without empty slots, slots of quantity 0 and size rows of anything but a prepack."""
    loose = same("type", NO_SIZE)
    empty = F.col("size_detail").isNull() | (F.coalesce("qty", F.lit(1)) == 0)
    return sized.where(loose | (~empty & same("size", PREPACK_SIZE)))


def _allocated(stock: str, fallback: Column) -> Column:
    units = F.col(stock).cast("decimal(12,0)") * F.col("qty").cast("decimal(10,0)")
    return F.coalesce(half_up_ratio(units, F.col("total_units").cast("decimal(12,0)"), 0), fallback).cast("int")


def stock_per_size(pruned: DataFrame) -> DataFrame:
    """Stock, work in progress and transit shared out by the size's part of the prepack.

    Without units per prepack the whole figure stands (transit: 0 when unknown).
    """
    return pruned.withColumns({
        "units_per_size": _allocated("avail_in_stock", F.col("avail_in_stock")),
        "wip_per_size": _allocated("wip", F.col("wip")),
        "in_transit_per_size": _allocated("in_transit", F.coalesce("in_transit", F.lit(0))),
    })


def final_stock(inventory: DataFrame, prepack: DataFrame) -> DataFrame:
    return stock_per_size(prepack_prune(size_upc_backfill(stock_by_size(inventory, prepack))))


def warehouse_list(inventory: DataFrame, override: DataFrame | None = None) -> DataFrame:
    """Warehouses in stock with their exclude mark and priority; blanks without an override."""
    seen = inventory.select("warehouse").distinct()
    if override is None:
        return seen.select("warehouse", F.lit("").alias("exclude"), F.lit("").alias("priority"))
    return seen.join(unique(override, ["warehouse"], "warehouse override"), "warehouse", "left").select(
        "warehouse", F.coalesce("exclude", F.lit("")).alias("exclude"), F.coalesce("priority", F.lit("")).alias("priority")
    )


def sellable_stock(final: DataFrame, warehouses: DataFrame) -> DataFrame:
    kept = warehouses.where(~same("exclude", EXCLUDED_CLASS)).select("warehouse").distinct()
    return final.join(kept, "warehouse", "left_semi")


def style_upc_lookup(sellable: DataFrame) -> DataFrame:
    """One row per style, color, size and UPC with its lookup text, sub division, season letter and year."""
    rest = F.struct("sub_div", "sub_div_desc", F.left("season", F.lit(1)).alias("season"), F.right("season", F.lit(2)).alias("year"))
    best = grouped(sellable.withColumn("size", F.col("size_detail")), [], ["style", "color", "size", "upc"], least={"row": rest})
    return best.select(F.concat("style", "color", "size").alias("lookup"), "upc", "style", "color", "size", "row.*")


def distinct_styles(sellable: DataFrame) -> DataFrame:
    return grouped(sellable, [], ["style"])
