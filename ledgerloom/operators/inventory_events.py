"""Inventory adjustments: event ledger, product match, ERP adjustment layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.numbering import rank_copies
from ledgerloom.functions.text import fold, grouped, one_of, same
from ledgerloom.operators.product_match import attach_products
from ledgerloom.params import EVENT_TYPES_SKIPPED, LAYOUT, NOT_IMPORTED, STOCK_ATTRIBUTES, ErpLayout

EVENT_KEYS = ["company_name", "event_date", "transaction_type", "fnsku", "sku", "fulfillment_center_id", "quantity", "disposition"]


def inventory_event_rank(events: DataFrame) -> DataFrame:
    """Events with their rank among equal events (text compared without case)."""
    text = {"company_name", "transaction_type", "fnsku", "sku", "fulfillment_center_id", "disposition"}
    return rank_copies(events.select(*EVENT_KEYS), [fold(c) if c in text else F.col(c) for c in EVENT_KEYS])


def inventory_event_ledger(
    events: DataFrame, start: Column, end: Column, skipped: tuple[str, ...] = EVENT_TYPES_SKIPPED
) -> DataFrame:
    """Adjusting events of a window of days, ranked, status open."""
    kept = events.where(F.col("event_date").between(start, end) & ~one_of("transaction_type", skipped))
    return inventory_event_rank(kept).withColumn("status", F.lit(NOT_IMPORTED))


def inventory_adjustment_conversion(ledger: DataFrame, resolved: DataFrame) -> DataFrame:
    """Distinct ledger events with product and ERP attributes.

    The product text falls back from product id to ASIN to the event's own ASIN where those are blank.
    Equal events share one row, whatever their rank.
    """
    columns = ["product_id", "product_asin", "erp_upc", *[a for a in STOCK_ATTRIBUTES if a != "warehouse"]]
    plain = ["event_date", "quantity"]
    events = grouped(ledger.where(same("status", NOT_IMPORTED)), plain, [k for k in EVENT_KEYS if k not in plain]).select(*EVENT_KEYS)
    merged = attach_products(events, resolved, columns)
    product = (
        F.when((F.col("product_asin") == "") & (F.col("product_id") == ""), F.col("fnsku"))
        .when(F.col("product_id") == "", F.col("product_asin"))
        .otherwise(F.col("product_id"))
    )
    return merged.withColumns({"product_asin": product, "style": F.coalesce("style", "sku")}).drop("product_id")


def inventory_adjustment_extract(converted: DataFrame, layout: ErpLayout = LAYOUT) -> DataFrame:
    """Units per product, sorted for the ERP; ``connected`` tells products the ERP knows."""
    units = grouped(converted, ["division"], ["season", "style", "color", "size", "pack_dim", "size_scale"], {"units": F.col("quantity")}, {"sku200": F.col("sku200")})
    return units.select(
        "division", F.left("season", F.lit(1)).alias("season"), F.right("season", F.lit(2)).alias("season_year"), "style", "sku200",
        F.col("color").alias("color_code"), F.col("pack_dim").alias("pack"), "size_scale", "size", "units",
        F.lit(layout.warehouse).alias("warehouse_in"), F.lit(layout.warehouse).alias("warehouse_out"),
        F.col("division").isNotNull().alias("connected"),
    ).orderBy("division", "style", "color_code")
