"""Which ERP product is a SKU? A cascade of keys into ERP stock, resolved once per SKU.

For every output column the first value along the rungs wins, so one product may mix rungs. All work
happens on tables of the size of the SKU or stock list: stock is reduced to one entry per key, rungs
that go through a product's ASIN are resolved once per ASIN, and the fact tables join the finished
list once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.sizing import marked_listed
from ledgerloom.functions.text import digit_run, drop_first, fold, is_blank, nonzero_number, same, starts_with_b
from ledgerloom.params import CHANNEL_MARKETPLACE, STOCK_ATTRIBUTES

ATTRIBUTES = ("erp_upc", *STOCK_ATTRIBUTES)


def canonical_inventory(inventory: DataFrame) -> DataFrame:
    """One stock row per UPC: the smallest by warehouse and then by the other columns."""
    rest = [c for c in inventory.columns if c not in ("upc", "warehouse")]
    row = F.min(F.struct("warehouse", *rest)).alias("row")
    best = inventory.where(nonzero_number("upc")).groupBy(fold("upc").alias("upc_key")).agg(F.min("upc").alias("upc"), row)
    return best.selectExpr("upc", *[f"row.{c} as {c}" for c in inventory.columns if c != "upc"])


def _upc_key(value: Column) -> Column:
    return F.concat(F.lit("u"), fold(value))


def _asin_key(value: Column) -> Column:
    return F.concat(F.lit("a"), fold(value))


def stock_lookup(inventory: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """``key`` (kind and folded text) with, per attribute, the smallest UPC that has a value and the value."""
    stock = canonical_inventory(inventory).withColumn("erp_upc", F.col("upc"))
    entry = {a: F.expr(f"case when {a} is not null then struct(upc, {a} as value) end") for a in attributes}
    by_upc = stock.select(_upc_key(F.col("upc")).alias("key"), *[e.alias(a) for a, e in entry.items()])
    by_asin = (
        stock.where(F.col("asin").isNotNull())
        .groupBy(_asin_key(F.col("asin")).alias("key"))
        .agg(*[F.min(e).alias(a) for a, e in entry.items()])
    )
    return by_upc.unionByName(by_asin)


def _ranked(candidates: DataFrame, lookup: DataFrame, kept: list[str], how: str = "inner") -> DataFrame:
    """Candidates (kept columns, rung, key) to ``struct(rung, upc, value)`` per attribute, not yet reduced."""
    values = [f"case when {a} is not null then struct(rung, {a}.upc as upc, {a}.value as value) end as {a}" for a in lookup.columns if a != "key"]
    return candidates.join(lookup, "key", how).selectExpr(*kept, *values)


def _candidates(df: DataFrame, owner: list[str], rungs: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: a row per rung whose key is not null."""
    pairs = F.array(*[F.struct(F.lit(r).alias("rung"), k.alias("key")) for r, k in rungs.items()])
    return df.select(*owner, F.inline(F.filter(pairs, lambda p: p["key"].isNotNull())))


def asin_upcs(product_data: DataFrame, marketplace_only: bool = False, any_upc: bool = False) -> DataFrame:
    """Distinct (asin, upc) of the product list whose upc is not itself an ASIN."""
    listed = product_data.where(F.col("asin").isNotNull())
    if marketplace_only:
        listed = listed.where(same("fulfillment_channel", CHANNEL_MARKETPLACE))
    if not any_upc:
        listed = listed.where(~starts_with_b("upc"))
    return listed.select(fold("asin").alias("asin_key"), "asin", "upc").distinct()


def _by_asin(pairs: DataFrame, lookup: DataFrame, rungs: dict[str, Column]) -> DataFrame:
    """One row per ASIN that has a pair: its smallest UPC and the rungs that go through the ASIN."""
    ranked = _ranked(_candidates(pairs, ["asin_key", "asin", "upc"], rungs), lookup, ["asin_key", "asin", "upc"], "left")
    return ranked.groupBy("asin_key").agg(
        F.min("asin").alias("listed_asin"), F.min("upc").alias("listed_upc"), *[F.min(a).alias(a) for a in lookup.columns if a != "key"]
    )


def resolve_products(
    skus: DataFrame,
    product_data: DataFrame,
    inventory: DataFrame,
    variant: str = "orders",
    events: DataFrame | None = None,
    attributes: Sequence[str] = STOCK_ATTRIBUTES,
) -> DataFrame:
    """One row per SKU of ``skus`` with the matched ERP attributes and the rung of ``erp_upc``.

    Variants: ``orders`` (orders and credits), ``report`` (missing-UPC report; products are taken by
    account and SKU when ``skus`` has an account), ``inventory`` (adjustments and the diagnostic; an
    ASIN may come from the events), ``two_rung`` (through the UPC only, marketplace-channel products or
    ``two_rung_any_channel``) and ``status`` (the later status marking of orders).
    Only the ``attributes`` asked for are carried.
    """
    carried = ["erp_upc", *[a for a in attributes if a != "erp_upc"]]
    lookup = stock_lookup(inventory, carried)
    product_key = ["account_name", "sku_key"] if "account_name" in skus.columns else ["sku_key"]
    wanted = skus.where(~is_blank("sku")).withColumn("sku_key", fold("sku"))
    wanted = wanted.select(*product_key, "sku").distinct()
    listed = product_data.withColumn("sku_key", fold("sku")).select(*product_key, "asin", "upc").distinct()
    products = wanted.join(listed, product_key, "left").select("sku_key", "sku", "asin", "upc")
    if "account_name" in product_key:
        products = products.distinct()
    products = products.withColumn("asin_key", fold("asin"))

    asin, upc = F.col("asin"), F.col("upc")
    by_upc, by_upc_tail = _upc_key(upc), _upc_key(drop_first(upc))
    listing = _asin_key(F.when(upc == "", asin).otherwise(upc))
    digits = digit_run(F.col("sku_key"))
    sku_rungs = {"I": _upc_key(digits), "J": _upc_key(drop_first(digits))}
    if variant == "orders":
        asin_rungs, product_rungs = {"E": _asin_key(asin), "F": by_upc, "G": by_upc_tail}, {"H": listing}
    elif variant == "report":
        asin_rungs, product_rungs = {"F": _asin_key(asin), "G": by_upc_tail}, {"E": by_upc, "H": listing}
    elif variant == "inventory":
        asin_rungs, product_rungs = {"E": by_upc, "F": _asin_key(asin), "G": by_upc_tail}, {"H": listing}
    elif variant in ("two_rung", "two_rung_any_channel"):
        asin_rungs, product_rungs, sku_rungs = {"E": by_upc, "F": by_upc_tail}, {}, {}
    elif variant == "status":
        asin_rungs, product_rungs, sku_rungs = {"E": by_upc, "F": by_upc_tail}, {"G": _asin_key(asin)}, {}
    else:
        raise ValueError(f"unknown variant {variant}")

    pairs = asin_upcs(product_data, marketplace_only=variant == "two_rung", any_upc=variant == "status")
    through_asin = products.join(_by_asin(pairs, lookup, asin_rungs), "asin_key", "left")
    about = {"sku": "sku", "upc": "product_id", "asin": "product_asin", "listed_asin": "listed_asin", "listed_upc": "listed_upc"}
    found = through_asin.select("sku_key", *about, *carried)
    keyed = []
    if product_rungs or sku_rungs:
        keyed.append(_candidates(products, ["sku_key"], {**product_rungs, **sku_rungs}))
    if variant == "inventory" and events is not None:
        seen = events.select(fold("sku").alias("sku_key"), F.col("fnsku").alias("seen_asin")).distinct()
        unlisted = through_asin.where(F.col("listed_asin").isNull()).select("sku_key").distinct()
        keyed.append(unlisted.join(seen, "sku_key").select("sku_key", F.lit("F").alias("rung"), _asin_key(F.col("seen_asin")).alias("key")))
    if keyed:
        ranked = _ranked(reduce(DataFrame.unionByName, keyed), lookup, ["sku_key"])
        found = found.unionByName(ranked, allowMissingColumns=True)
    best = found.groupBy("sku_key").agg(
        *[F.min(c).alias(name) for c, name in about.items()], *[F.min(a).alias(a) for a in carried]
    )
    return best.selectExpr("sku_key", *about.values(), "erp_upc.rung as rung", *[f"{a}.value as {a}" for a in carried])


def attach_products(facts: DataFrame, resolved: DataFrame, columns: list[str]) -> DataFrame:
    """Left join of facts to resolved products by SKU.

    Facts without a SKU cannot match. They get keys of their own, spread by their content, so that the
    account-level fees of a large settlement do not meet in one task. The join has a key that the list is not already
    partitioned by: both sides are then shuffled for it, and adaptive execution can split the facts of a hot SKU.
    """
    unmatched = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*facts.columns), F.lit(4096)).cast("string"))
    key = F.when(is_blank("sku"), unmatched).otherwise(F.concat(F.lit("s"), fold("sku")))
    listed = resolved.select(F.concat(F.lit("s"), F.col("sku_key")).alias("_sku_key"), *columns)
    return facts.withColumn("_sku_key", key).join(listed, "_sku_key", "left").drop("_sku_key")


def with_known(facts: DataFrame, resolved: DataFrame, name: str) -> DataFrame:
    """``facts`` with whether their SKU has a product in ``resolved`` (an ``erp_upc``); facts without a SKU have none.

    Maps of hashes are broadcast, one of the SKUs that have a product and one of the other SKUs of the facts. A SKU is in one of
    these lists, so a fact that only one map lets pass is settled where it lies; the few that both let pass travel to the list itself.
    """
    key = F.coalesce(F.when(~is_blank("sku"), F.concat(F.lit("s"), fold("sku"))), F.lit(""))
    keyed = facts.withColumn("_sku", key)
    known = resolved.where(F.col("erp_upc").isNotNull()).select(F.concat(F.lit("s"), F.col("sku_key")).alias("_listed"))
    others = keyed.select(F.col("_sku").alias("_listed")).distinct().join(known, "_listed", "left_anti")
    told = marked_listed(marked_listed(keyed, F.col("_sku"), known, "_known"), F.col("_sku"), others, "_other").drop("_sku")
    settled = told.where(~(F.col("_known") & F.col("_other"))).drop("_other").withColumnRenamed("_known", name)
    unsure = attach_products(told.where(F.col("_known") & F.col("_other")).select(*facts.columns), resolved, ["erp_upc"])
    return settled.unionByName(unsure.withColumn(name, F.col("erp_upc").isNotNull()).drop("erp_upc"))


def resolve_by_asin(product_data: DataFrame, inventory: DataFrame) -> DataFrame:
    """ERP UPC per ASIN through the product list's UPC or its tail (the draft adjustment rule)."""
    upc = F.col("upc")
    rungs = {"E": _upc_key(upc), "F": _upc_key(drop_first(upc))}
    found = _by_asin(asin_upcs(product_data), stock_lookup(inventory, ["erp_upc"]), rungs)
    return found.select("asin_key", F.col("erp_upc.value").alias("erp_upc"))


def stock_of_upc(upcs: DataFrame, inventory: DataFrame) -> DataFrame:
    """Attributes of the stock row of a UPC, each falling back to the row of the UPC's tail."""
    keys = {"E": _upc_key(F.col("erp_upc")), "F": _upc_key(drop_first("erp_upc"))}
    wanted = upcs.where(F.col("erp_upc").isNotNull()).select("erp_upc").distinct().withColumnRenamed("erp_upc", "_upc")
    wanted = wanted.withColumn("erp_upc", F.col("_upc"))
    ranked = _ranked(_candidates(wanted, ["_upc"], keys), stock_lookup(inventory, STOCK_ATTRIBUTES), ["_upc"])
    best = ranked.groupBy("_upc").agg(*[F.min(a).alias(a) for a in STOCK_ATTRIBUTES])
    return best.select(F.col("_upc").alias("erp_upc"), *[F.col(f"{a}.value").alias(a) for a in STOCK_ATTRIBUTES])
