"""Jobs on the product list: listing backfill, missing-UPC report, match diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.text import digit_run, drop_first, fold, is_blank, starts_with_b
from ledgerloom.operators.product_match import canonical_inventory, resolve_products


def listing_upc_backfill(product_data: DataFrame, all_listings: DataFrame) -> DataFrame:
    """Product UPCs replaced by the listing's product id where that is not an ASIN; the smallest of several."""
    listed = (
        all_listings.where(~starts_with_b("product_id"))
        .groupBy(fold("account_name").alias("_account"), fold("seller_sku").alias("_sku"))
        .agg(F.min("product_id").alias("listed_id"))
    )
    match = (fold("account_name") == F.col("_account")) & (fold("sku") == F.col("_sku"))
    joined = product_data.join(listed, match, "left")
    return joined.withColumn("upc", F.coalesce("listed_id", "upc")).select(*product_data.columns)


def missing_upc_report(skus: DataFrame, product_data: DataFrame, inventory: DataFrame) -> DataFrame:
    """SKUs that no rung and no 12-digit number in the SKU leads to stock, by SKU."""
    resolved = resolve_products(skus, product_data, inventory, "report", attributes=())
    missing = resolved.where(F.col("erp_upc").isNull()).select(
        "sku", F.col("listed_asin").alias("asin"),
        F.when(F.col("product_id") != "", F.col("product_id")).alias("product_id"), F.col("listed_upc").alias("upc"),
    )
    number = digit_run("sku")
    second = F.when(is_blank("upc"), F.when(F.octet_length(number) == 12, number).otherwise(F.col("sku")))
    stock = canonical_inventory(inventory).select(fold("upc").alias("_upc"))
    left = missing.withColumn("_second", fold(second))
    # Rows without a second chance look up a text no UPC has, each its own, rather than one shared null.
    left = left.withColumn("_second", F.coalesce("_second", F.concat(F.lit("\u0000"), "sku")))
    unmatched = left.join(stock, left["_second"] == stock["_upc"], "left_anti")
    return unmatched.select("sku", "asin", "product_id", "upc", F.lit(None).cast("string").alias("erp_upc")).orderBy("sku")


def upc_match_diagnostic(skus: DataFrame, product_data: DataFrame, inventory: DataFrame, events: DataFrame) -> DataFrame:
    """Every key of the cascade and its result, per SKU."""
    resolved = resolve_products(skus, product_data, inventory, "inventory", events, attributes=())
    seen = events.groupBy(fold("sku").alias("sku_key")).agg(F.min("fnsku").alias("seen_asin"))
    joined = resolved.join(seen, "sku_key", "left")
    return joined.select(
        "sku", digit_run("sku").alias("sku_digits"), F.coalesce("listed_asin", "seen_asin").alias("asin"),
        F.col("listed_upc").alias("upc"), drop_first("listed_upc").alias("upc_tail"),
        (F.octet_length("listed_upc") - 1).alias("tail_length"), "erp_upc",
    )


def upc_match_rungs(resolved: DataFrame) -> DataFrame:
    """How many SKUs each rung settles."""
    return resolved.groupBy(F.coalesce("rung", F.lit("none")).alias("rung")).agg(F.count("*").alias("skus"))


def related_products_by_asin(product_data: DataFrame, orders: DataFrame) -> DataFrame:
    """Products that share an ASIN with a converted order.

    The result repeats a product once per order line and listing behind its ASIN; the multiplicity is
    counted per ASIN first and reported, not unfolded.
    """
    per_sku = orders.groupBy(fold("sku").alias("sku_key")).agg(F.count("*").alias("lines"))
    listed = product_data.where(F.col("asin").isNotNull()).select(fold("sku").alias("sku_key"), fold("asin").alias("asin_key"))
    counted = listed.groupBy("sku_key", "asin_key").agg(F.count("*").alias("listings"))
    per_asin = counted.join(per_sku, "sku_key").groupBy("asin_key").agg(F.sum(F.col("listings") * F.col("lines")).alias("order_lines"))
    return product_data.join(per_asin, fold(product_data["asin"]) == per_asin["asin_key"]).drop("asin_key")
