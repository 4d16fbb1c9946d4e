"""The fee ledger: statement lines with duplicate rank, class code and line number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.dates import local_day
from ledgerloom.functions.numbering import number_sorted, number_within, rank_copies
from ledgerloom.functions.sizing import join_dimension
from ledgerloom.functions.text import fold, fold_blank, grouped, is_blank, same
from ledgerloom.params import NOT_IMPORTED, POSTED

FEE_KEYS = ("transaction_type", "fee_category", "fee_type")


def ledger_lines(settlements: DataFrame) -> DataFrame:
    """Statement lines under the ledger's names, blank order and SKU instead of null, status open.

    The totals of orders, credits and reconciliation need no more than this; rank, number and class
    are added only where they are part of the result.
    """
    return settlements.select(
        "account_name", "settlement_id", "currency", "start_date", "end_date", "posted_date",
        F.coalesce("order_id", F.lit("")).alias("order_id"), F.coalesce("sku", F.lit("")).alias("sku"),
        "transaction_type", F.col("amount_type").alias("fee_category"), F.col("amount_description").alias("fee_type"),
        "amount", "quantity_purchased", F.lit(NOT_IMPORTED).alias("status"),
    )


def fee_classes(reference: DataFrame) -> DataFrame:
    """One row per fee key (case and null-or-blank folded): the class codes of one of its rows and how many rows share it."""
    pair = F.min(F.when(F.col("class_code").isNotNull(), F.struct("class_code", "subclass_code"))).alias("pair")
    classes = reference.groupBy(*[fold_blank(k).alias(k) for k in FEE_KEYS]).agg(pair, F.count("*").alias("line_count"))
    return classes.select(
        *FEE_KEYS, F.col("pair.class_code").alias("credit_memo_class"), F.col("pair.subclass_code").alias("credit_memo_sub_class"), "line_count"
    )


def classify(lines: DataFrame, reference: DataFrame) -> DataFrame:
    """Adds class, sub class and the number of matching reference rows; unmapped lines keep nulls."""
    return join_dimension(lines, fee_classes(reference), {k: fold_blank(k) for k in FEE_KEYS})


def join_null_blank(lines: DataFrame, reference: DataFrame) -> DataFrame:
    """Lines joined to the whole reference row, null and blank being the same key; rows of the reference that share a key all join."""
    named = reference.select(
        *[fold_blank(k).alias(k) for k in FEE_KEYS],
        *[F.col(k).alias(f"reference_{k}") for k in FEE_KEYS],
        *[c for c in reference.columns if c not in FEE_KEYS],
    )
    return join_dimension(lines, named, {k: fold_blank(k) for k in FEE_KEYS})


def _duplicate_keys() -> list[Column]:
    return [
        F.col("account_name"), F.col("settlement_id"), local_day("posted_date"), fold("order_id"), fold("sku"),
        fold("transaction_type"), fold("fee_category"), fold("fee_type"), F.col("amount"), F.col("quantity_purchased"),
    ]


def duplicate_ranks(lines: DataFrame) -> DataFrame:
    """Rank of each line among the lines equal to it within a settlement and local business day."""
    return rank_copies(lines, _duplicate_keys())


LEDGER_ORDER = [
    "posted_date", "order_id", "sku", "currency", "transaction_type", "fee_category", "fee_type", "amount",
    "quantity_purchased", "ranking",
]


def line_numbers(ranked: DataFrame) -> DataFrame:
    """Sequence number of each line inside its settlement, by posting time, order and SKU."""
    return number_sorted(ranked, LEDGER_ORDER, ["account_name", "settlement_id"])


def fee_ledger(settlements: DataFrame, reference: DataFrame) -> DataFrame:
    lines = ledger_lines(settlements)
    classed = classify(line_numbers(duplicate_ranks(lines)), reference).drop("credit_memo_sub_class")
    return classed.withColumn("line_count", F.coalesce("line_count", F.lit(1).cast("bigint")))


def settlement_period(lines: DataFrame) -> DataFrame:
    return lines.groupBy("account_name", "settlement_id").agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")
    )


def with_period_label(df: DataFrame, lines: DataFrame) -> DataFrame:
    """``df``, which has account and settlement, with the ``period`` its files are named by: first and last day of the settlement."""
    label = F.concat_ws("_", F.col("start_date").cast("string"), F.col("end_date").cast("string")).alias("period")
    labels = settlement_period(lines).select(F.col("account_name").alias("_account"), F.col("settlement_id").cast("string").alias("_settlement"), label)
    match = (df["account_name"] == F.col("_account")) & (df["settlement_id"].cast("string") == F.col("_settlement"))
    return df.join(labels, match, "left").drop("_account", "_settlement")


def settlement_skus(settlements: DataFrame, start: Column, end: Column) -> DataFrame:
    """Distinct (account, SKU) posted in a window of local business days."""
    day = local_day("posted_date")
    return grouped(settlements.where(~is_blank("sku") & day.between(start, end)), ["account_name"], ["sku"])


def pending_settlements(settlements: DataFrame, exported: DataFrame, start: Column) -> DataFrame:
    """Posted settlements from ``start`` on that have not been exported, by end date."""
    posted = settlements.where(same("status", POSTED) & (local_day("posted_date") >= start))
    ids = posted.select("account_name", "settlement_id", "start_date", "end_date").distinct()
    return ids.join(exported.select("account_name", "settlement_id").distinct(), ["account_name", "settlement_id"], "left_anti").orderBy(
        "account_name", "end_date", "settlement_id"
    )


def settlement_months(stored: DataFrame, settlements: DataFrame) -> DataFrame:
    """Every month that lines of these settlements are stored under; a settlement whose lines differ in end date has several."""
    keys = ["account_name", "settlement_id"]
    return stored.select(*keys, "end_month").distinct().join(settlements.select(*keys), keys, "left_semi")


def lines_of(stored: DataFrame, months: DataFrame) -> DataFrame:
    """The stored lines of some settlements. While ``months`` (stored itself, so its size is known) is small enough to be
    broadcast, it prunes the months read from ``stored``; beyond that it is an ordinary semi-join with the same rows."""
    # The planner prunes by a side only if that is filtered; every month is more than the empty text.
    return stored.join(months.where(F.col("end_month") > ""), ["account_name", "settlement_id", "end_month"], "left_semi")


def settlement_calendar(settlements: DataFrame) -> DataFrame:
    """Periods per account: the day after a settlement starts up to the day before the next period starts.

    The last period ends with the latest settlement of the account. Distinct start days are counted
    before the window, so it sees days, not lines.
    """
    starts = settlements.groupBy("account_name", F.date_add("start_date", 1).alias("start_date")).agg(
        F.max("end_date").alias("last")
    )
    account = Window.partitionBy("account_name")
    following = F.lead("start_date", 1).over(account.orderBy("start_date"))
    end = F.coalesce(F.date_sub(following, 1), F.max("last").over(account))
    return starts.select("account_name", "start_date", end.alias("end_date")).withColumn(
        "date_range", F.datediff("end_date", "start_date")
    )


def fee_reference_refresh(settlements: DataFrame, reference: DataFrame) -> DataFrame:
    """The reference plus every fee key of the statements it does not know, numbered on from its last id."""
    known = reference.select(*[fold_blank(k).alias(f"_{k}") for k in FEE_KEYS]).distinct()
    names = {"transaction_type": "transaction_type", "fee_category": "amount_type", "fee_type": "amount_description"}
    seen = settlements.select(*[F.coalesce(F.col(c), F.lit("")).alias(k) for k, c in names.items()]).distinct()
    match = [fold(k) == F.col(f"_{k}") for k in FEE_KEYS]
    new = seen.join(known, match, "left_anti")
    # Spellings that differ in case are one key.
    new = new.groupBy(*[fold(k).alias(f"_{k}") for k in FEE_KEYS]).agg(*[F.min(k).alias(k) for k in FEE_KEYS]).select(*FEE_KEYS)
    numbered = number_within(new, [], list(FEE_KEYS), "_n")
    last = reference.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))
    blank = [c for c in reference.columns if c not in ("id", *FEE_KEYS)]
    added = numbered.join(F.broadcast(last)).select(
        (F.col("_last") + F.col("_n")).cast("int").alias("id"), *FEE_KEYS, *[F.lit("").alias(c) for c in blank]
    )
    return reference.unionByName(added)


def raw_settlement_extract(settlements: DataFrame, reference: DataFrame) -> DataFrame:
    """Every statement line with its reference row, for the per-settlement raw files."""
    lines = settlements.withColumnsRenamed({"amount_type": "fee_category", "amount_description": "fee_type"})
    return join_null_blank(lines, reference)


def check_unique_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are null or occur more than once; an empty result means the key holds."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("key_count")).where((F.col("key_count") > 1) | null_key)


def check_single_period(lines: DataFrame) -> DataFrame:
    """Settlements and how many different start and end dates and currencies they carry (one each is right)."""
    dates = lines.select("account_name", "settlement_id", "start_date", "end_date", "currency").distinct()
    return dates.groupBy("account_name", "settlement_id").agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
        F.count_distinct("start_date").alias("start_dates"), F.count_distinct("end_date").alias("end_dates"),
        F.count_distinct("currency").alias("currencies"),
    )
