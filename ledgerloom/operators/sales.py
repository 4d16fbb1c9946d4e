"""Sales orders: roll-up of settlement lines per order and SKU, product attributes, ERP order layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.money import cents, half_up_ratio, money, of_cents
from ledgerloom.functions.sizing import unique
from ledgerloom.functions.text import contains_tax, fold, grouped, is_blank, one_of, same
from ledgerloom.operators.product_match import attach_products
from ledgerloom.params import (
    CHANNEL_FBA, CHANNEL_FBM, ITEM_PRICE, LAYOUT, LIQUIDATION_TYPES, NOT_IMPORTED, ORDER_TYPES, PRICE_TYPE, PRINCIPAL,
    RESERVE_TYPES, STOCK_ATTRIBUTES, ErpLayout,
)

EXTRACT_ATTRIBUTES = ["division", "sub_div", "season", "style", "color", "pack_dim", "size"]
STATEMENT_KEYS = ["account_name", "settlement_id", "currency", "start_date", "end_date"]


def is_principal(category: str = ITEM_PRICE) -> Column:
    return same("fee_category", category) & same("fee_type", PRINCIPAL)


def principal_quantity() -> Column:
    return F.when(same("fee_type", PRINCIPAL), F.col("quantity_purchased"))


SUMS = ["total_amount", "principal", "tax"]


def order_totals(lines: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Quantity, and ``SUMS`` in cents, per order and SKU, with their folded keys and whether the order has a number; lines combine before the shuffle."""
    kind = lines.schema["amount"].dataType
    wanted = (
        same("status", NOT_IMPORTED) & one_of("transaction_type", types) & ~one_of("transaction_type", RESERVE_TYPES)
    )
    # Each is told once per line: several sums use it.
    told = lines.where(wanted).withColumns({
        "amount": cents(F.col("amount"), kind),
        "_named": same("fee_type", PRINCIPAL), "_item": same("fee_category", ITEM_PRICE), "_tax": contains_tax("fee_type"),
        "_sold": one_of("transaction_type", LIQUIDATION_TYPES) & same("fee_category", PRICE_TYPE),
    })
    named = F.col("_named")
    return grouped(
        told, STATEMENT_KEYS, ["order_id", "sku"],
        {
            "quantity": F.when(named, F.col("quantity_purchased")), "total_amount": F.col("amount"),
            "principal": F.when(named & (F.col("_item") | F.col("_sold")), F.col("amount")).otherwise(0),
            "tax": F.when(F.col("_tax"), F.col("amount")).otherwise(0),
        },
        {"posted_date": F.col("posted_date"), "_named": ~is_blank("order_id")}, with_keys=True,
    )


def order_channels(all_orders: DataFrame) -> DataFrame:
    """Distinct (order, SKU, channel) under folded keys."""
    return all_orders.select(
        fold("order_id").alias("order_key"), fold("sku").alias("sku_key"), "fulfillment_channel"
    ).distinct()


def in_channel(orders: DataFrame, all_orders: DataFrame, channel: str) -> DataFrame:
    """Orders whose (order, SKU) was fulfilled through ``channel``; both sides are reduced to keys first.

    Account-level lines have no order and leave before the join.
    """
    orders = orders.where("_named")
    keys = all_orders.where(same("fulfillment_channel", channel)).select(fold("order_id").alias("order_key"), fold("sku").alias("sku_key")).distinct()
    match = (F.col("_key_order_id") == F.col("order_key")) & (F.col("_key_sku") == F.col("sku_key"))
    return orders.join(keys, match, "left_semi").drop("_named", "_key_order_id", "_key_sku").withColumn("fulfillment_channel", F.lit(channel))


def _rollup(lines: DataFrame, types: tuple[str, ...], all_orders: DataFrame, channel: str) -> DataFrame:
    """Sums become decimals when they have travelled to meet the channels."""
    kind = lines.schema["amount"].dataType
    return in_channel(order_totals(lines, types), all_orders, channel).withColumns({name: of_cents(F.col(name), kind) for name in SUMS})


def order_rollup_fba(lines: DataFrame, all_orders: DataFrame) -> DataFrame:
    return _rollup(lines, ORDER_TYPES + LIQUIDATION_TYPES, all_orders, CHANNEL_FBA)


def order_rollup_fbm(lines: DataFrame, all_orders: DataFrame) -> DataFrame:
    return _rollup(lines, ORDER_TYPES, all_orders, CHANNEL_FBM)


def order_enriched(orders: DataFrame, resolved: DataFrame) -> DataFrame:
    """Orders with the ERP attributes of their SKU; an unmatched style falls back to the SKU."""
    attributes = [a for a in STOCK_ATTRIBUTES if a != "size_scale"]
    merged = attach_products(orders, resolved, ["product_id", "erp_upc", *attributes])
    return merged.withColumn("style", F.coalesce("style", "sku"))


def unit_prices(orders: DataFrame, fx: DataFrame | None) -> DataFrame:
    """Unit price at 2 and 4 decimals, MXN converted by the settlement's rate (no rate, no price)."""
    quantity = F.col("quantity").cast("decimal(12,0)")
    divisor = quantity.cast("decimal(22,10)")
    if fx is not None:
        # Only orders in pesos look up a rate; the others get keys of their own, which no rate has, spread over the tasks.
        pesos = same("currency", "MXN")
        own = F.concat(F.lit("-"), F.xxhash64("order_id", "sku").cast("string"))
        rates = unique(fx, ["settlement_id"], "exchange rates").select(F.col("settlement_id").cast("string").alias("rate_key"), "exchange_value")
        keyed = orders.withColumn("rate_key", F.when(pesos, F.col("settlement_id").cast("string")).otherwise(own))
        orders = keyed.join(rates, "rate_key", "left").drop("rate_key")
        rate = F.when(same("currency", "MXN"), F.col("exchange_value")).otherwise(F.lit(1)).cast("decimal(20,10)")
        divisor = quantity * rate
    priced = orders.withColumns({
        "price_2": half_up_ratio(F.col("principal"), divisor, 2), "price_4": half_up_ratio(F.col("principal"), divisor, 4)
    })
    return priced if fx is None else priced.drop("exchange_value")


def store_number(layout: ErpLayout, account: str = "account_name") -> Column:
    """Store number of an account; null when the account is not in the layout, which has to name the stores."""
    if not layout.stores:
        raise ValueError("the layout names no stores: give ErpLayout(stores={account: number})")
    number = F.lit(None).cast("int")
    for name, store in layout.stores.items():
        number = F.when(same(account, name), F.lit(store)).otherwise(number)
    return number


def customer_code(codes: dict[str, str], layout: ErpLayout, account: str = "account_name") -> Column:
    code = F.lit(None).cast("string")
    for currency, value in codes.items():
        code = F.when(same("currency", currency), F.lit(value)).otherwise(code)
    return F.when(store_number(layout, account).isNotNull(), code)


def blanks(first: int, last: int) -> list[Column]:
    return [F.lit("").alias(f"blank_{i}") for i in range(first, last + 1)]


def sales_extract(
    orders: DataFrame,
    resolved: DataFrame,
    fx: DataFrame | None = None,
    currencies: tuple[str, ...] | None = None,
    layout: ErpLayout = LAYOUT,
) -> DataFrame:
    """ERP order lines per settlement, product and unit price.

    Attributes depend on the SKU alone. Orders hardly share a SKU and a price, so they meet the product list as they are
    and are added up once, per product and price.
    """
    if currencies is not None:
        orders = orders.where(one_of("currency", currencies))
    keys = ["account_name", "settlement_id", "currency", "end_date"]
    priced = unit_prices(orders, fx).select(*keys, "price_2", "sku", F.col("quantity").alias("units"), "tax", "price_4")
    merged = attach_products(priced, resolved, EXTRACT_ATTRIBUTES)
    merged = merged.withColumn("style", F.coalesce("style", "sku"))
    summed = grouped(
        merged, [*keys, "division", "sub_div", "price_2"], ["style", "color", "pack_dim", "size"],
        {"units": F.col("units"), "tax": F.col("tax")}, {"price_4": F.col("price_4"), "season": F.col("season")},
    )
    number = F.concat_ws(
        "_", F.col("settlement_id").cast("string"), F.coalesce(F.col("division").cast("string"), F.lit("")),
        F.coalesce(F.col("sub_div").cast("string"), F.lit("")),
    )
    day = F.date_format("end_date", "MM/dd/yyyy")
    # Names and order of the ERP's order layout.
    return summed.select(
        "account_name", "settlement_id", "currency",
        F.lit(layout.company).alias("company"), "division",
        customer_code(layout.sales_customer, layout).alias("customer_number"),
        store_number(layout).alias("store_number"), number.alias("external_order_number"),
        day.alias("order_date"), day.alias("start_date"), day.alias("cancel_date"),
        F.lit(layout.terms).alias("terms"), F.lit(layout.routing).alias("routing"), F.lit(layout.warehouse).alias("warehouse"),
        F.lit(layout.sales_rep).alias("sales_rep"), number.alias("customer_po_number"), *blanks(1, 6),
        F.lit(0).alias("merch_discount"), F.lit(layout.order_type).alias("order_type"),
        F.left("season", F.lit(1)).alias("style_season"), F.right("season", F.lit(2)).alias("style_year"),
        "style", F.lit("").alias("sku200"), F.col("color").alias("sku300"), F.col("pack_dim").alias("sku400"),
        F.col("size").alias("size_code"), "units",
        F.col("price_2").alias("customer_price"), F.col("price_2").alias("cop_price"),
        F.col("price_4").alias("customer_price_1"), F.col("price_4").alias("cop_price_1"),
        F.lit(0).alias("dollar_discount"), *blanks(7, 14), F.lit(0).alias("misc"), F.lit(0).alias("freight"),
        money(F.col("tax")).alias("tax"), *blanks(15, 17), F.lit(layout.order_origin).alias("order_origin"),
    )


def sales_connected_split(extract: DataFrame) -> DataFrame:
    """Marks the lines whose product is known to the ERP; each mark goes to its own file."""
    return extract.withColumn("connected", F.col("division").isNotNull())


def merchant_export(orders_fbm: DataFrame) -> DataFrame:
    """Merchant-fulfilled orders with every column as text."""
    return orders_fbm.select(*[F.col(c).cast("string").alias(c) for c in orders_fbm.columns])
