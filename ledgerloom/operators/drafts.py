"""Earlier and alternative settlement jobs: order-grain and line-grain layouts, refunds, status marking.

They read statement lines in the older vocabulary: company_name, posted_date, posted_date_1 (the
posting day), fee_category and fee_type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.dates import local_day, shift_zone
from ledgerloom.functions.money import cents, money, of_cents
from ledgerloom.functions.numbering import number_sorted, rank_copies
from ledgerloom.functions.sizing import perhaps_listed
from ledgerloom.functions.text import contains_tax, fold, grouped, grouped_apart, is_blank, one_of, same
from ledgerloom.operators.product_match import attach_products, resolve_by_asin, stock_of_upc, with_known
from ledgerloom.operators.sales import blanks, is_principal
from ledgerloom.params import (
    COMPLETE, DRAFT_LAYOUT, FREIGHT_FEES, ITEM_FEE_TYPE, NOT_IMPORTED, OPEN, PRICE_TYPE, PRINCIPAL, STOCK_ATTRIBUTES, DraftLayout,
)

ORDER = "Order"
REFUND = "Refund"
MERGED_ATTRIBUTES = [a for a in STOCK_ATTRIBUTES if a != "size_scale"]


# Listings and totals of statement lines


def daily_principal_total(statements: DataFrame, as_of: Column) -> DataFrame:
    """Principal of the orders posted the day before ``as_of``."""
    day = F.date_sub(as_of, 1)
    wanted = (F.col("posted_date_1") == day) & same("transaction_type", ORDER) & same("fee_type", PRINCIPAL)
    return statements.where(wanted).agg(money(F.sum("amount")).alias("amount"))


def duplicate_lines(statements: DataFrame, as_of: Column, days: int = 60) -> DataFrame:
    """Lines of the last days with their rank among equal lines and the count of their group."""
    keys = ["posted_date_1", "order_id", "sku", "fee_category", "fee_type", "amount"]
    recent = statements.where(F.col("posted_date_1") > F.date_sub(as_of, days)).select(*keys)
    group = [F.col("posted_date_1"), *[fold(k) for k in keys[1:5]], F.col("amount")]
    return rank_copies(recent, group).withColumns({"line_count": F.lit(1).cast("bigint"), "active": F.lit("")})


def recent_order_principals(statements: DataFrame, as_of: Column, days: int = 20) -> DataFrame:
    """Principal lines of orders posted in the last days, whole, with their rank among equal lines."""
    wanted = (F.col("posted_date_1") > F.date_sub(as_of, days)) & same("transaction_type", ORDER) & same("fee_type", PRINCIPAL)
    group = [F.col("posted_date_1"), fold("order_id"), fold("sku"), fold("fee_category"), fold("fee_type"), F.col("amount")]
    return rank_copies(statements.where(wanted), group)


def skus_since(statements: DataFrame, first: Column) -> DataFrame:
    """SKUs of the lines posted on ``first`` or later."""
    return grouped(statements.where((F.col("posted_date_1") >= first) & ~is_blank("sku")), [], ["sku"])


def order_sku_representative(statements: DataFrame, as_of: Column, days: int = 2) -> DataFrame:
    """One line per order and SKU of a day: the smallest by its other columns."""
    wanted = (F.col("posted_date_1") == F.date_sub(as_of, days)) & same("transaction_type", ORDER)
    rest = [c for c in statements.columns if c not in ("order_id", "sku")]
    best = grouped(statements.where(wanted), [], ["order_id", "sku"], least={"row": F.struct(*rest)})
    return best.select("order_id", "sku", "row.*")


def refund_lines_open(statements: DataFrame, as_of: Column, days: int = 20) -> DataFrame:
    """Open refunded principal lines with a quantity, ranked among equal lines."""
    wanted = (
        (F.col("posted_date_1") > F.date_sub(as_of, days)) & same("transaction_type", REFUND) & same("status", OPEN)
        & (F.col("quantity_purchased") != 0) & same("fee_type", PRINCIPAL)
    )
    group = [F.col("posted_date_1"), fold("order_id"), fold("sku"), fold("fee_category"), fold("fee_type"), F.col("amount")]
    return rank_copies(statements.where(wanted), group)


def local_day_totals(statements: DataFrame, day: Column, zone: str = "+03:00", target: str = "+00:00") -> DataFrame:
    """Totals per company and fee of a business day kept on ``target`` clocks."""
    wanted = statements.where(local_day("posted_date", zone, target) == day)
    return grouped(wanted, ["company_name"], ["transaction_type", "fee_category", "fee_type"], {"amount": F.col("amount")}).withColumn("amount", money(F.col("amount")))


def local_day_ledger(
    statements: DataFrame, first: Column, last: Column, zone: str = "+03:00", target: str = "+00:00"
) -> DataFrame:
    """Ranked and numbered lines of business days kept on ``target`` clocks, numbered per company."""
    columns = ["company_name", "posted_date", "posted_date_1", "order_id", "sku", "transaction_type", "fee_category", "fee_type",
               "amount", "quantity_purchased"]
    lines = statements.where(local_day("posted_date", zone, target).between(first, last)).select(*columns)
    group = [F.col("company_name"), F.col("posted_date_1"), *[fold(c) for c in columns[3:8]], F.col("amount"), F.col("quantity_purchased")]
    ranked = rank_copies(lines, group)
    blanked = ranked.withColumns({c: F.coalesce(c, F.lit("")) for c in ("order_id", "sku")})
    order = ["posted_date", "order_id", "sku", "transaction_type", "fee_category", "fee_type", "amount", "quantity_purchased", "ranking"]
    return number_sorted(blanked, order, ["company_name"]).withColumns({
        "posted_at_target": shift_zone("posted_date", zone, target), "line_count": F.lit(1).cast("bigint"), "status": F.lit(NOT_IMPORTED),
    })


def settlement_day_total(statements: DataFrame, day: Column) -> DataFrame:
    return statements.where(F.col("posted_date_1") == day).groupBy("company_name", "settlement_id", "settlement_batch").agg(
        money(F.sum("amount")).alias("amount")
    )


def zone_comparison(statements: DataFrame, day: Column) -> DataFrame:
    """One instant on several clocks: totals per order and type of the day on -03:00 clocks."""
    shown = statements.where(local_day("posted_date", "+00:00", "-03:00") == day).withColumns({
        "posted_utc": shift_zone("posted_date", "US/Eastern", "UTC"), "posted_plus_five": shift_zone("posted_date", "+00:00", "+05:00"),
    })
    keys = ["settlement_id", "settlement_batch", "posted_utc", "posted_date", "posted_plus_five"]
    return grouped(shown, keys, ["order_id", "transaction_type"], {"amount": F.col("amount")}).withColumn("amount", money(F.col("amount")))


def statement_discrepancy(statement_lines: DataFrame) -> DataFrame:
    """Statement total against the sum of its lines."""
    sums = statement_lines.groupBy("settlement_id", "settlement_batch", "start_date", "end_date").agg(
        F.max("total_amount").alias("total_amount"), money(F.sum("amount")).alias("amount")
    )
    return sums.withColumns({
        "matched": F.col("total_amount") == F.col("amount"), "discrepancy": money(F.col("total_amount") - F.col("amount")),
    })


def order_lookup(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """All lines of the wanted orders. Of a list too long to be broadcast a map of its hashes is, so that few other lines travel to the join."""
    wanted = orders.select(fold("order_id").alias("order_key")).distinct()
    key = fold(lines["order_id"])
    return perhaps_listed(lines, key, wanted).join(wanted, key == F.col("order_key"), "left_semi")


def settlement_day_lookup(statements: DataFrame, settlements: DataFrame, day: Column, zone: str = "US/Eastern", target: str = "US/Pacific") -> DataFrame:
    """All lines of the wanted settlements on a business day kept on ``target`` clocks, with the shifted time."""
    shifted = statements.withColumn("posted_at_target", shift_zone("posted_date", zone, target))
    wanted = shifted.where(F.to_date("posted_at_target") == day)
    return wanted.join(settlements.select("settlement_id").distinct(), "settlement_id", "left_semi")


# Orders at order grain


def draft_ledger(statements: DataFrame) -> DataFrame:
    """Statement lines with their duplicate rank, blanks for missing orders and SKUs, status open."""
    columns = ["company_name", "posted_date", "posted_date_1", "order_id", "sku", "transaction_type", "fee_category", "fee_type",
               "amount", "quantity_purchased"]
    group = [F.col("company_name"), F.col("posted_date_1"), *[fold(c) for c in columns[3:8]], F.col("amount"), F.col("quantity_purchased")]
    return open_lines(rank_copies(statements.select(*columns), group))


def open_lines(statements: DataFrame) -> DataFrame:
    return statements.withColumns({
        "order_id": F.coalesce("order_id", F.lit("")), "sku": F.coalesce("sku", F.lit("")), "status": F.lit(NOT_IMPORTED),
    })


def order_buckets(lines: DataFrame, all_orders: DataFrame) -> DataFrame:
    """Order totals in four buckets: principal, freight, tax and everything else.

    Sums are taken before the channel is looked up. An order and SKU listed under several channels
    counts once per channel, as a join before the sums would.
    """
    principal = is_principal(PRICE_TYPE)
    freight = same("fee_category", ITEM_FEE_TYPE) & one_of("fee_type", FREIGHT_FEES)
    tax = contains_tax("fee_type")
    wanted = same("status", NOT_IMPORTED) & same("transaction_type", ORDER)
    kind = lines.schema["amount"].dataType
    sums = grouped(
        lines.where(wanted).withColumn("amount", cents(F.col("amount"), kind)), ["company_name"], ["order_id", "sku"],
        {"quantity": F.col("quantity_purchased"), "total_amount": F.col("amount"),
         **{name: F.when(cond, F.col("amount")).otherwise(0)
            for name, cond in (("principal", principal), ("freight", freight), ("tax", tax), ("misc", ~principal & ~freight & ~tax))}},
        {"posted_date": F.col("posted_date")},
    )
    # Channels of an order and SKU are few: one aggregation, under the keys of the join, and no shuffle to make them distinct first.
    channel = F.col("fulfillment_channel")
    channels = all_orders.groupBy(fold("order_id").alias("order_key"), fold("sku").alias("sku_key")).agg(
        F.min(channel).alias("fulfillment_channel"), (F.size(F.collect_set(channel)) + F.max(channel.isNull().cast("int"))).cast("bigint").alias("times")
    )
    match = (fold("order_id") == F.col("order_key")) & (fold("sku") == F.col("sku_key"))
    joined = sums.join(channels, match, "left").drop("order_key", "sku_key")
    times = F.coalesce("times", F.lit(1))
    scaled = {c: money(of_cents(F.col(c), kind) * times.cast("decimal(6,0)")) for c in ("total_amount", "principal", "freight", "tax", "misc")}
    return joined.withColumns({"quantity": F.col("quantity") * times, **scaled}).drop("times")


def orders_without_channel(buckets: DataFrame) -> DataFrame:
    return buckets.where(F.col("fulfillment_channel").isNull())


def two_rung_match(orders: DataFrame, resolved: DataFrame) -> DataFrame:
    """Orders, credits or refunds with ERP attributes; those without a product drop out."""
    merged = attach_products(orders, resolved, ["listed_upc", "erp_upc", *MERGED_ATTRIBUTES])
    return merged.where(F.col("erp_upc").isNotNull())


def order_extract_order_grain(merged: DataFrame, with_division: bool = False, layout: DraftLayout = DRAFT_LAYOUT) -> DataFrame:
    """ERP order lines per order: whole amounts, with the freight and misc buckets."""
    number = F.col("order_id")
    if with_division:
        number = F.concat("order_id", F.lit("_"), F.coalesce(F.col("division").cast("string"), F.lit("")))
    # Names and order of the earlier order layout.
    return merged.select(
        F.lit(layout.company).alias("company"), "division", F.lit(layout.customer).alias("customer_number"),
        F.lit(layout.order_store).alias("store_number"), number.alias("external_order_number"),
        F.col("posted_date").alias("order_date"), F.col("posted_date").alias("start_date"), F.col("posted_date").alias("cancel_date"),
        F.lit(layout.terms).alias("terms"), F.lit(layout.routing).alias("routing"), F.lit(layout.warehouse).alias("warehouse"),
        F.lit(layout.sales_rep).alias("sales_rep"), number.alias("customer_po_number"), *blanks(1, 6), F.lit(0).alias("merch_discount"),
        F.lit("S").alias("order_type"), F.left("season", F.lit(1)).alias("style_season"), F.right("season", F.lit(2)).alias("style_year"),
        "style", "sku200", F.col("color").alias("sku300"), F.col("pack_dim").alias("sku400"), F.col("size").alias("size_code"),
        F.col("quantity").alias("units"), money(F.col("principal")).alias("customer_price"), money(F.col("principal")).alias("cop_price"),
        F.lit(0).alias("dollar_discount"), *blanks(7, 14), money(F.col("misc")).alias("misc"), money(F.col("freight")).alias("freight"),
        money(F.col("tax")).alias("tax"), *blanks(15, 17), F.lit("A").alias("order_origin"),
    )


def sku_match_list(resolved: DataFrame) -> DataFrame:
    """SKUs with their ASIN, product id and UPC, and whether the list and the stock know them."""
    return resolved.select(
        "sku", F.col("product_asin").alias("asin"), "product_id", F.col("listed_upc").alias("upc"), "erp_upc",
        F.col("listed_upc").isNotNull().alias("has_upc"), F.col("erp_upc").isNotNull().alias("has_erp_upc"),
    )


# Credits at line grain, refunds


def refund_revenue() -> Column:
    """Refunded principal or tax of the price category."""
    refund = same("transaction_type", REFUND) & same("fee_category", PRICE_TYPE)
    return (refund & same("fee_type", PRINCIPAL)) | (refund & contains_tax("fee_type"))


def line_grain_credit() -> Column:
    """Neither an order nor refunded revenue; told by keys that equal lines share."""
    return ~same("transaction_type", ORDER) & ~refund_revenue()


def credit_rollup_line_grain(ranked: DataFrame) -> DataFrame:
    wanted = same("status", NOT_IMPORTED) & line_grain_credit()
    return grouped_apart(
        ranked.where(wanted), ["company_name", "posted_date", "ranking"], ["order_id", "sku", "transaction_type", "fee_category", "fee_type"],
        {"quantity": F.col("quantity_purchased"), "total_amount": F.col("amount")},
    ).withColumn("total_amount", money(F.col("total_amount")))


def credit_extract_line_grain(credits: DataFrame, resolved: DataFrame, layout: DraftLayout = DRAFT_LAYOUT) -> DataFrame:
    """ERP credit lines one by one; lines without a SKU stay although no product matches them."""
    merged = attach_products(credits, resolved, ["erp_upc", "division", "sub_div", "season", "style", "color"])
    kept = merged.where(F.col("erp_upc").isNotNull() | (F.col("sku") == ""))
    blank = F.lit("")
    return kept.select(
        F.lit(layout.company).alias("company"), F.coalesce("division", F.lit(0)).alias("division"), blank.alias("invoice_number"),
        F.col("posted_date").alias("invoice_date"), F.left("season", F.lit(1)).alias("season"),
        F.lit(layout.customer).alias("customer_number"), F.lit(layout.line_store).alias("store_number"), blank.alias("order_type"),
        F.concat("order_id", F.lit("_"), F.col("division").cast("string")).alias("customer_po_number"),
        F.lit(layout.warehouse).alias("warehouse"), F.coalesce(F.col("sub_div").cast("string"), blank).alias("sub_division"),
        blank.alias("factor_code"), F.lit(layout.sales_rep).alias("sales_rea"), F.lit(layout.sales_rep).alias("sales_rep"),
        blank.alias("terms_code"), F.col("total_amount").alias("amount"), F.col("transaction_type").alias("misc_description"),
        F.col("fee_category").alias("credit_memo_class"), F.col("fee_type").alias("credit_memo_sub_class"),
        F.lit(layout.business_unit).alias("business_unit"), blank.alias("y_tax"), blank.alias("tax_amount"),
        F.lit(layout.sales_rep).alias("sales_manager"), F.coalesce("style", blank).alias("style"), blank.alias("fabric"),
        F.coalesce("color", blank).alias("color"),
    )


def refund_rollup(lines: DataFrame) -> DataFrame:
    """Refunded quantity, principal and tax per order and SKU."""
    return grouped(
        lines.where(same("status", NOT_IMPORTED) & refund_revenue()), ["company_name"], ["order_id", "sku"],
        {
            "quantity": F.when(same("fee_type", PRINCIPAL), F.col("quantity_purchased")).otherwise(0), "total_amount": F.col("amount"),
            "principal": F.when(is_principal(PRICE_TYPE), F.col("amount")).otherwise(0),
            "tax": F.when(contains_tax("fee_type"), F.col("amount")).otherwise(0),
        },
        {"posted_date": F.col("posted_date")},
    ).withColumns({c: money(F.col(c)) for c in ("total_amount", "principal", "tax")})


def refund_extract(refunds: DataFrame, resolved: DataFrame, layout: DraftLayout = DRAFT_LAYOUT) -> DataFrame:
    """ERP refund lines of matched products; the amount is given twice, as the layout asks."""
    merged = two_rung_match(refunds, resolved)
    amount = money(F.col("principal") + F.col("tax"))
    return merged.select(
        F.lit(layout.company).alias("company"), "division", F.lit(layout.warehouse).alias("warehouse"),
        F.lit(layout.customer).alias("customer_number"), F.lit(layout.line_store).alias("store_number"), F.lit("C").alias("col_1"),
        F.lit("R").alias("col_2"), F.left("season", F.lit(1)).alias("style_season"), F.lit("0").alias("col_3"),
        F.col("listed_upc").alias("upc"), "quantity", amount.alias("amount"), amount.alias("amount_1"), F.lit("0").alias("col_4"),
        F.lit("0").alias("col_5"), F.lit("").alias("blank_1"), F.col("order_id").alias("external_order_number"),
        F.lit(layout.sales_rep).alias("col_6"), F.lit("S").alias("col_7"), "posted_date", F.lit("$").alias("col_8"),
    )


# Status marking and draft adjustments


def mark_complete(lines: DataFrame, resolved: DataFrame) -> DataFrame:
    """Lines with the status after conversion: complete once their product is known.

    Order lines and refunded revenue need a product; other fees are complete without a SKU as well.
    """
    marked = with_known(lines, resolved, "_known")
    known = F.col("_known")
    credit = ~same("transaction_type", ORDER) & ~refund_revenue()
    done = known & (same("transaction_type", ORDER) | refund_revenue()) | credit & (known | (F.col("sku") == ""))
    return marked.withColumn("status", F.when(done, F.lit(COMPLETE)).otherwise(F.col("status"))).drop("_known")


def event_products(events: DataFrame, product_data: DataFrame, inventory: DataFrame) -> DataFrame:
    """Product per event SKU: ASIN by SKU, else by product id equal to the SKU, then UPC or its tail."""
    with_asin = product_data.where(F.col("asin") != "")
    by_sku = with_asin.groupBy(fold("sku").alias("sku_key")).agg(F.min("asin").alias("sku_asin"))
    by_id = with_asin.where(F.col("upc").isNotNull()).groupBy(fold("upc").alias("sku_key")).agg(F.min("asin").alias("id_asin"))
    skus = events.where(~is_blank("sku")).select(fold("sku").alias("sku_key")).distinct()
    named = skus.join(by_sku, "sku_key", "left").join(by_id, "sku_key", "left").select(
        "sku_key", F.coalesce("sku_asin", "id_asin").alias("product_asin")
    )
    matched = named.join(
        resolve_by_asin(product_data, inventory), fold(named["product_asin"]) == F.col("asin_key"), "left"
    ).drop("asin_key")
    return matched.join(stock_of_upc(matched, inventory), "erp_upc", "left")


def stock_adjustment_draft(ledger: DataFrame, resolved: DataFrame) -> DataFrame:
    """Adjustment lines of distinct events; events without a SKU stay although nothing matches them."""
    keys = ["company_name", "event_date", "transaction_type", "fnsku", "sku", "fulfillment_center_id", "quantity", "disposition"]
    events = grouped(ledger.where(same("status", NOT_IMPORTED)), ["event_date", "quantity"], [k for k in keys if k not in ("event_date", "quantity")]).select(*keys)
    merged = attach_products(events, resolved, ["erp_upc", "division", "season", "style", "sku200", "color", "pack_dim", "size"])
    kept = merged.where(F.col("erp_upc").isNotNull() | (F.col("sku") == ""))
    return kept.select(
        "division", F.left("season", F.lit(1)).alias("season"), F.right("season", F.lit(2)).alias("season_year"), "style", "sku200",
        F.lit("").alias("blank_1"), "color", F.col("pack_dim").alias("size_scale"), "size", "quantity",
        F.lit(DRAFT_LAYOUT.warehouse).alias("warehouse_in"), F.lit(DRAFT_LAYOUT.warehouse).alias("warehouse_out"),
    ).orderBy("division", "style", "color")


def mark_events_complete(ledger: DataFrame, resolved: DataFrame) -> DataFrame:
    marked = attach_products(ledger, resolved, ["erp_upc"])
    done = F.when(F.col("erp_upc").isNotNull(), F.lit(COMPLETE)).otherwise(F.col("status"))
    return marked.withColumn("status", done).drop("erp_upc")
