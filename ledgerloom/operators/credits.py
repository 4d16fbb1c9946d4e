"""Credit memos: every open line that is not the principal or tax of an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.money import half_up_ratio, money
from ledgerloom.functions.sizing import unique
from ledgerloom.functions.text import contains_tax, grouped, grouped_apart, one_of, same
from ledgerloom.operators.ledger import classify
from ledgerloom.operators.product_match import attach_products
from ledgerloom.operators.sales import STATEMENT_KEYS, customer_code, is_principal, principal_quantity, store_number
from ledgerloom.params import EXCLUDED_CLASS, LAYOUT, NOT_IMPORTED, ORDER_TYPES, STOCK_ATTRIBUTES, ErpLayout


EXTRACT_ATTRIBUTES = ["division", "sub_div"]


def order_revenue() -> Column:
    """Principal or tax of an order; null (neither true nor false) for an order line without fee names."""
    return one_of("transaction_type", ORDER_TYPES) & (is_principal() | contains_tax("fee_type"))


def is_credit() -> Column:
    return same("status", NOT_IMPORTED) & ~order_revenue()


def credit_rollup(ranked: DataFrame) -> DataFrame:
    """Credits per posting time, order, SKU, fee and duplicate rank, so true duplicates stay apart."""
    return grouped_apart(
        ranked.where(is_credit()), [*STATEMENT_KEYS, "posted_date", "ranking"], ["order_id", "sku", "transaction_type", "fee_category", "fee_type"],
        {"quantity": principal_quantity(), "total_amount": F.col("amount")},
    )


def credit_enriched(credits: DataFrame, resolved: DataFrame) -> DataFrame:
    merged = attach_products(credits, resolved, ["product_id", "erp_upc", *STOCK_ATTRIBUTES])
    return merged.withColumn("style", F.coalesce("style", "sku"))


def credit_extract(
    lines: DataFrame,
    reference: DataFrame,
    resolved: DataFrame,
    fx: DataFrame | None = None,
    currencies: tuple[str, ...] | None = None,
    layout: ErpLayout = LAYOUT,
) -> DataFrame:
    """ERP credit memo lines: negated totals per division, sub division, class and transaction type.

    Lines without a class and lines of the excluded class drop out. The rank does not reach this
    layout, so the sums run over the lines themselves. SKUs are too many for sums per SKU and settlement to be much fewer
    than the lines, so these meet the product list as they are; the sums per product that follow are few, whatever the spelling.
    """
    if currencies is not None:
        lines = lines.where(one_of("currency", currencies))
    classed = classify(lines.where(is_credit()), reference).where(~same("credit_memo_class", EXCLUDED_CLASS))
    keys, names = ["account_name", "settlement_id", "currency", "end_date"], ["credit_memo_class", "credit_memo_sub_class", "transaction_type"]
    merged = attach_products(classed.select(*keys, *names, "sku", "amount"), resolved, EXTRACT_ATTRIBUTES)
    division = F.coalesce("division", F.lit(layout.default_division))
    sub_division = F.coalesce(F.col("sub_div").cast("string"), F.lit(layout.default_sub_division))
    merged = merged.withColumns({"division": division, "sub_division": sub_division})
    # By exact spelling first, which a hash aggregation can do before the shuffle; the few sums are then added up without case.
    by_spelling = merged.groupBy(*keys, "division", "sub_division", *names).agg(F.sum("amount").alias("total"))
    totals = grouped(by_spelling, [*keys, "division", "sub_division"], names, {"total": F.col("total")}).withColumn("total", F.col("total").cast("decimal(22,2)"))
    amount = -F.col("total")
    if fx is not None:
        totals = totals.join(unique(fx, ["settlement_id"], "exchange rates"), "settlement_id", "left")
        converted = half_up_ratio(-F.col("total"), F.col("exchange_value"), 2)
        amount = F.when(same("currency", "MXN"), converted).otherwise(amount)
    # Names and order of the ERP's credit layout.
    return totals.select(
        "account_name", "settlement_id", "currency",
        F.lit(layout.company).alias("company"), "division", F.lit("").alias("invoice_number"),
        F.date_format("end_date", "MM/dd/yy").alias("invoice_date"), F.lit(layout.credit_season).alias("season"),
        customer_code(layout.credit_customer, layout).alias("customer_number"), store_number(layout).alias("store_number"),
        F.lit("").alias("order_type"),
        F.concat_ws("_", F.col("settlement_id").cast("string"), F.col("division").cast("string")).alias("customer_po_number"),
        F.lit(layout.warehouse).alias("warehouse"), "sub_division", F.lit("").alias("factor_code"),
        F.lit(layout.credit_rep).alias("sales_rea"), F.lit(layout.sales_rep).alias("sales_rep"), F.lit(layout.terms).alias("terms_code"),
        money(amount).alias("amount"), F.col("transaction_type").alias("misc_description"),
        "credit_memo_class", "credit_memo_sub_class", F.lit(layout.business_unit).alias("business_unit"),
        F.lit("").alias("y_tax"), F.lit("").alias("tax_amount"), F.lit(layout.sales_rep).alias("sales_manager"),
        F.concat(F.col("sub_division"), F.lit(layout.credit_style_suffix)).alias("style"), F.lit("").alias("fabric"),
        F.lit(layout.credit_color).alias("color"),
    )


def credit_connected_split(extract: DataFrame) -> DataFrame:
    """Marks lines for the connected file: all but those with a style and no color."""
    loose = F.col("style").isNotNull() & F.col("color").isNull() & (F.col("style") != "")
    return extract.withColumn("connected", ~loose)
