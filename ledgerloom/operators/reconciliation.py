"""Proof that orders and credits add up to the statement, one row per settlement and side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.money import cents, money, of_cents
from ledgerloom.functions.text import contains_tax, fold, one_of, same
from ledgerloom.operators.ledger import classify, settlement_period
from ledgerloom.operators.sales import is_principal, order_channels
from ledgerloom.params import (
    CHANNEL_FBA, CHANNEL_FBM, CURRENCIES, EXCLUDED_CLASS, ORDER_TYPES, RECON_LOGIC, RECON_RAW, RESERVE_TYPES,
)

CHANNELS = (("fba", CHANNEL_FBA), ("fbm", CHANNEL_FBM))
BUCKETS = [f"{c}_{m}_{u.lower()}" for c in ("fba", "fbm") for m in ("orders", "tax") for u in CURRENCIES] + [
    f"credits_{u.lower()}" for u in CURRENCIES
]
RECON_COLUMNS = ["account_name", "type", "settlement_id", "start_date", "end_date", "total_amount", *BUCKETS, "exclusions", "unmapped"]


def _sum_where(condition: Column, value: str) -> Column:
    return money(F.sum(F.when(condition, F.col(value)).otherwise(0)))


def recon_raw(lines: DataFrame, all_orders: DataFrame, reference: DataFrame) -> DataFrame:
    """The statement side: order principal and tax per channel and currency, credits, exclusions, unmapped.

    The measures are added up per order and SKU before the channel list is joined, which leaves one
    row for all lines without an order and turns a hot order into one row per settlement.
    """
    # Each is told once per line: several measures use it.
    kind = lines.schema["amount"].dataType
    told = classify(lines, reference).withColumns({
        "amount": cents(F.col("amount"), kind),
        "_ordered": one_of("transaction_type", ORDER_TYPES), "_reserve": one_of("transaction_type", RESERVE_TYPES),
        "_principal": is_principal(), "_tax": contains_tax("fee_type"), "_excluded": same("credit_memo_class", EXCLUDED_CLASS),
    })
    order, reserve, principal, tax, excluded = (F.col(c) for c in ("_ordered", "_reserve", "_principal", "_tax", "_excluded"))
    measures = {
        "total": F.lit(True),
        "orders": order & principal,
        "tax": order & tax,
        "credits": ~reserve & ~excluded & ~(order & (principal | tax)),
        "excluded": reserve | excluded,
        "unclassed": F.col("credit_memo_class").isNull(),
    }
    keys = ["account_name", "settlement_id", "currency", "start_date", "end_date"]
    # Under the keys of the join, so that spellings of an order travel as one row.
    per_order = told.groupBy(*keys, fold("order_id").alias("_order"), fold("sku").alias("_sku")).agg(
        *[F.sum(F.when(cond, F.col("amount")).otherwise(0)).alias(name) for name, cond in measures.items()]
    )
    match = (F.col("_order") == F.col("order_key")) & (F.col("_sku") == F.col("sku_key"))
    joined = per_order.join(order_channels(all_orders), match, "left").withColumns({name: of_cents(F.col(name), kind) for name in measures})
    # Channel and currency are compared, and the buckets parted, on the sums of a settlement and not once per order.
    sums = joined.groupBy("account_name", "settlement_id", "currency", "fulfillment_channel").agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"), *[F.sum(name).alias(name) for name in measures])
    buckets = []
    for prefix, channel in CHANNELS:
        for measure in ("orders", "tax"):
            for currency in CURRENCIES:
                condition = same("fulfillment_channel", channel) & same("currency", currency)
                buckets.append(_sum_where(condition, measure).alias(f"{prefix}_{measure}_{currency.lower()}"))
    for currency in CURRENCIES:
        buckets.append(_sum_where(same("currency", currency), "credits").alias(f"credits_{currency.lower()}"))
    return sums.groupBy("account_name", "settlement_id").agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
        money(F.sum("total")).alias("total_amount"), *buckets,
        money(F.sum("excluded")).alias("exclusions"), money(F.sum("unclassed")).alias("unmapped"),
    ).withColumn("type", F.lit(RECON_RAW)).select(*RECON_COLUMNS)


def _labelled(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(account, settlement, bucket, amount) of one kind of output, all its measures from one pass."""
    sums = df.groupBy("account_name", "settlement_id", "currency").agg(*[money(F.sum(v)).alias(p) for p, v in values.items()])
    rows = F.array(*[
        F.struct(F.concat(F.lit(f"{p}_"), F.lower("currency")).alias("bucket"), F.col(p).alias("amount")) for p in values
    ])
    return sums.select("account_name", "settlement_id", F.inline(rows))


def recon_logic(lines: DataFrame, sales: DataFrame, orders_fbm: DataFrame, credits: DataFrame) -> DataFrame:
    """The produced side: the same buckets from the extracts; settlements without output get zeros."""
    price = F.col("customer_price_1") * F.col("units").cast("decimal(12,0)")
    amounts = reduce(DataFrame.unionByName, [
        _labelled(sales, {"fba_orders": money(price, 34, 4), "fba_tax": F.col("tax")}),
        _labelled(orders_fbm, {"fbm_orders": F.col("principal"), "fbm_tax": F.col("tax")}),
        _labelled(credits, {"credits": -F.col("amount")}),
    ])
    sums = amounts.groupBy("account_name", "settlement_id").agg(
        money(F.sum("amount")).alias("total_amount"), *[_sum_where(F.col("bucket") == b, "amount").alias(b) for b in BUCKETS]
    )
    zero = money(F.lit(0))
    filled = settlement_period(lines).join(sums, ["account_name", "settlement_id"], "left")
    return filled.withColumns({
        "type": F.lit(RECON_LOGIC), "exclusions": zero, "unmapped": zero, **{b: F.coalesce(b, zero) for b in BUCKETS},
    }).select(*RECON_COLUMNS)


def replace_by_key(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``current`` with the rows of the keys in ``changes`` replaced; running it twice changes nothing."""
    return current.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(changes)


def recon_report(raw: DataFrame, logic: DataFrame) -> DataFrame:
    """Both sides with the difference per settlement that exclusions and unmapped fees do not explain."""
    explained = F.col("total_amount") - F.col("exclusions") - F.col("unmapped")
    signed = F.when(F.col("type") == RECON_RAW, explained).otherwise(-F.coalesce("total_amount", F.lit(0)))
    both = Window.partitionBy("account_name", "settlement_id")
    return raw.unionByName(logic).withColumn("difference", money(F.sum(signed).over(both)))
