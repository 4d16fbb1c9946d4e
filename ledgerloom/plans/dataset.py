"""The settlement tables, derived from the given star-schema tables.

Every frame is a projection of a given table: whole tables, no sampling. One scan of ``lineitem``
yields all fee lines of an item through ``inline`` rather than one pass per fee.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.params import PREPACK_SLOTS, ErpLayout
from ledgerloom.sources.feeds import dealt_out, read_table

MONEY = "decimal(12,2)"
FIXTURE_LAYOUT = ErpLayout(stores={"acct_0": 1, "acct_1": 2, "acct_2": 3})
AS_OF = "2001-10-31"

# Fee classification for the derived statements: id, transaction type, fee category, fee type, memo
# class, memo sub class, notes, class code, sub class code. Case and blanks vary on purpose.
FEE_REFERENCE = [
    (1, "order", "ItemFees", "commission", "MARKET COSTS", "COMMISSION", "per order", "MKT", "COM"),
    (2, "Order", "itemfees", "FBAPerUnitFulfillmentFee", "MARKET COSTS", "HANDLING", "per order", "MKT", "HND"),
    (3, "Order", "Promotion", "Principal", "CAMPAIGNS", "DISCOUNT", "campaigns", "CMP", "DSC"),
    (4, "Refund", "ItemPrice", "Principal", "MONEY BACK", "GOODS", "refunded", "BCK", "GDS"),
    (5, "refund", "itemprice", "tax", "MONEY BACK", "TAX", "refunded", "BCK", "TAX"),
    (6, "Refund", "ItemFees", "Commission", "MARKET COSTS", "COMMISSION", "per order", "MKT", "COM"),
    (7, "Liquidations", "PRICE_TYPE", "Principal", "SOLD OFF", "REST STOCK", "rest stock", "OFF", "RST"),
    (8, "Payable to Amazon", "", "", "NONE", "CARRIED OVER", "balance", "X", "X"),
    (9, "Current Reserve Amount", None, None, "NONE", "CARRIED OVER", "balance", "X", "X"),
    (10, "Storage Fee", None, "", "MARKET COSTS", "STORAGE", "stock", "MKT", "STO"),
]
FEE_REFERENCE_SCHEMA = (
    "id int, transaction_type string, fee_category string, fee_type string, credit_memo_class string, "
    "credit_memo_sub_class string, notes string, class_code string, subclass_code string"
)


def sku_of(key: str) -> str:
    return (
        f"case {key} % 7 when 4 then concat('AB-', cast(100000000000 + {key} as string)) "
        f"when 5 then concat('AB-0', cast(100000000000 + {key} as string)) "
        f"else concat('SKU-', cast({key} as string)) end"
    )


def asin_of(key: str) -> str:
    return f"concat('B0', lpad(cast({key} as string), 8, '0'))"


def _settlement_keys(party: str, day: str) -> list[str]:
    month = f"(year({day}) * 100 + month({day}))"
    currency = f"(case when {party} % 10 < 6 then 0 when {party} % 10 < 9 then 1 else 2 end)"
    return [
        f"concat('acct_', cast({party} % 3 as string)) as account_name",
        f"cast({month} * 100 + {party} % 3 * 10 + {currency} as bigint) as settlement_id",
        f"case {currency} when 0 then 'USD' when 1 then 'CAD' else 'MXN' end as currency",
        f"cast(trunc(to_date({day}), 'MM') as date) as start_date",
        f"last_day(to_date({day})) as end_date",
        f"case when {month} >= 200110 then 'OPEN' else 'POSTED' end as status",
    ]


SETTLEMENT_COLUMNS = [
    "account_name", "settlement_id", "currency", "start_date", "end_date", "posted_date", "order_id", "sku",
    "transaction_type", "amount_type", "amount_description", "amount", "quantity_purchased", "status",
]


class Dataset:
    """Lazy frames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def lineitem(self) -> DataFrame:
        """A given table of few row groups, which as few tasks would read, is dealt out; one that is cut finely enough is read as it lies."""
        return dealt_out(self.table("lineitem"), by=["l_orderkey", "l_partkey"])

    @cached_property
    def settlements(self) -> DataFrame:
        item = self.lineitem.selectExpr(
            *_settlement_keys("l_suppkey", "l_shipdate"),
            "l_shipdate + make_dt_interval(0, l_linenumber) as posted_date",
            "concat('ORD-', cast(l_orderkey as string)) as order_id",
            f"{sku_of('l_partkey')} as sku",
            "case when l_returnflag = 'R' then 'Refund' when l_linenumber = 7 then 'Liquidations' "
            "when l_linenumber = 6 and l_linestatus = 'F' then 'TBYB Order Payment' else 'Order' end as transaction_type",
            f"cast(l_extendedprice as {MONEY}) as price",
            "cast(l_tax as decimal(4,2)) as tax",
            "cast(l_discount as decimal(4,2)) as disc",
            "cast(l_quantity as int) as qty",
            "l_linestatus = 'F' as fulfilled",
        )
        sign = "case when transaction_type = 'Refund' then -1 else 1 end"

        def fee(category: str, fee_type: str, amount: str, quantity: str = "null", when: str = "true") -> str:
            return (f"case when {when} then struct({category} as amount_type, '{fee_type}' as amount_description, "
                    f"cast({amount} as {MONEY}) as amount, cast({quantity} as int) as quantity_purchased) end")

        fees = "array(" + ", ".join([
            fee("case when transaction_type = 'Liquidations' then 'PRICE_TYPE' else 'ItemPrice' end", "Principal", f"price * {sign}", "qty"),
            fee("'ItemPrice'", "Tax", f"round(price * tax, 2) * {sign}"),
            fee("'ItemFees'", "Commission", "-round(price * disc, 2)"),
            fee("'ItemFees'", "Commission", "-round(price * disc, 2)", when="tax = 0"),
            fee("'Promotion'", "Principal", "-round(price * cast(0.01 as decimal(4,2)), 2)", "qty", "disc = 0.10"),
            fee("'ItemFees'", "FBAPerUnitFulfillmentFee", "-qty * cast(0.50 as decimal(4,2))", when="fulfilled"),
        ]) + ")"
        kept = [c for c in SETTLEMENT_COLUMNS if c not in ("amount_type", "amount_description", "amount", "quantity_purchased")]
        items = item.selectExpr(*kept, f"inline({fees}) as (amount_type, amount_description, amount, quantity_purchased)").where("amount is not null")
        # The same order or SKU is spelled differently from fee to fee, in case and accents.
        items = items.withColumns({
            "order_id": F.expr("case when amount_description = 'Tax' then replace(lower(order_id), 'o', 'ó') else order_id end"),
            "sku": F.expr("case when amount_type = 'Promotion' then replace(lower(sku), 'u', 'ú') else sku end"),
        })
        account_fees = self.table("orders").selectExpr(
            *_settlement_keys("o_custkey", "o_orderdate"),
            "o_orderdate as posted_date",
            "cast(null as string) as order_id",
            "cast(null as string) as sku",
            "case o_orderpriority when '1-URGENT' then 'Payable to Amazon' when '2-HIGH' then 'Previous Reserve Amount Balance' "
            "when '3-MEDIUM' then 'Current Reserve Amount' when '5-LOW' then 'Storage Fee' else 'Subscription Fee' end as transaction_type",
            "cast(null as string) as amount_type",
            "cast(null as string) as amount_description",
            f"cast(-round(cast(o_totalprice as {MONEY}) * cast(0.01 as decimal(4,2)), 2) as {MONEY}) as amount",
            "cast(null as int) as quantity_purchased",
        )
        return items.select(*SETTLEMENT_COLUMNS).unionByName(account_fees.select(*SETTLEMENT_COLUMNS))

    @cached_property
    def statements(self) -> DataFrame:
        """The same lines in the older vocabulary and column names of the draft jobs."""
        return self.settlements.select(
            F.col("account_name").alias("company_name"), "settlement_id",
            F.expr("settlement_id * 10 + 1").alias("settlement_batch"),
            "start_date", "end_date", "posted_date", F.to_date("posted_date").alias("posted_date_1"),
            "order_id", "sku", "transaction_type",
            F.expr("case amount_type when 'ItemPrice' then 'PRICE_TYPE' when 'ItemFees' then 'ITEM_RELATED_FEE_TYPE' else amount_type end").alias("fee_category"),
            F.col("amount_description").alias("fee_type"),
            "amount", "quantity_purchased", "status",
        )

    @cached_property
    def statement_lines(self) -> DataFrame:
        """Statement lines led by one header row per settlement that carries the statement total."""
        lines = self.statements.select("settlement_id", "settlement_batch", "start_date", "end_date",
                                       F.lit(None).cast("decimal(34,2)").alias("total_amount"), "amount")
        header = self.statements.groupBy("settlement_id", "settlement_batch", "start_date", "end_date").agg(
            F.sum(F.expr("case when transaction_type = 'Storage Fee' and posted_date_1 = end_date then 0 else amount end")).cast("decimal(34,2)").alias("total_amount")
        ).withColumn("amount", F.lit(0).cast(MONEY))
        return lines.unionByName(header)

    @cached_property
    def fee_reference(self) -> DataFrame:
        """The reference as literal rows, whose size the planner knows, as it knows that of a stored table; of rows handed over by
        the driver it knows none and would shuffle every fact to meet them."""
        def literal(value: object) -> str:
            return "null" if value is None else str(value) if isinstance(value, int) else f"'{value}'"

        rows = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in FEE_REFERENCE)
        names = [part.split() for part in FEE_REFERENCE_SCHEMA.split(", ")]
        return self.spark.sql(f"select * from values {rows} as t({', '.join(n for n, _ in names)})").select(*[F.col(n).cast(kind) for n, kind in names])

    @cached_property
    def fx_rates(self) -> DataFrame:
        return self.settlements.where("currency = 'MXN' and month(end_date) <> 12").selectExpr(
            "settlement_id",
            "cast(cast(1700 + settlement_id % 97 as decimal(10,0)) * cast(0.01 as decimal(4,2)) as decimal(20,10)) as exchange_value",
        ).distinct()

    @cached_property
    def product_data(self) -> DataFrame:
        return self.table("part").selectExpr(
            "inline(array(struct('acct_0'), struct('acct_1'), struct('acct_2'))) as (account_name)", "*"
        ).selectExpr(
            "account_name",
            f"{sku_of('p_partkey')} as sku",
            f"case when p_partkey % 7 <= 3 then {asin_of('p_partkey')} end as asin",
            "case p_partkey % 7 when 0 then '' "
            "when 1 then case when account_name <> 'acct_2' then cast(100000000000 + p_partkey as string) end "
            "when 2 then concat('0', cast(100000000000 + p_partkey as string)) "
            f"when 3 then {asin_of('p_partkey')} end as upc",
            "case when p_size <= 25 then 'AMAZON_NA' else 'DEFAULT' end as fulfillment_channel",
        )

    @cached_property
    def all_listings(self) -> DataFrame:
        return self.table("part").selectExpr(
            "inline(array(struct('acct_0'), struct('acct_1'))) as (account_name)", "*"
        ).selectExpr(
            "account_name", f"{sku_of('p_partkey')} as seller_sku",
            f"case when p_size <= 20 then cast(100000000000 + p_partkey as string) when p_size <= 40 then {asin_of('p_partkey')} end as product_id",
        )

    @cached_property
    def all_orders(self) -> DataFrame:
        return self.lineitem.selectExpr(
            "concat('ORD-', cast(l_orderkey as string)) as order_id",
            f"{sku_of('l_partkey')} as sku",
            "case l_orderkey % 5 when 0 then 'Merchant' when 1 then null else 'Amazon' end as fulfillment_channel",
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return self.table("part").selectExpr(
            "explode(case when p_type = 'STANDARD' then array(297, 298) when p_type = 'SMALL' then array(300) else array(297) end) as warehouse", "*"
        ).selectExpr(
            "case when p_size < 50 then cast(replace(p_brand, 'Brand#', '') as int) end as division",
            "p_brand as div_name",
            "cast(p_size % 7 as int) as sub_div",
            "concat('SD', cast(p_size % 7 as string)) as sub_div_desc",
            "warehouse",
            "concat('WH ', cast(warehouse as string)) as warehouse_name",
            "concat(substring(p_type, 1, 1), cast(20 + p_partkey % 5 as string)) as season",
            "p_type as style",
            "case when p_size <> 33 then split_part(p_name, ' ', 1) end as color",
            "case when p_size <= 12 then 'PP1' when p_size <= 40 then 'M' when p_size <= 45 then 'W' else 'OTH' end as pack_dim",
            "case when p_size <= 10 then 'PPK' when p_size < 49 then cast(p_size as string) end as size",
            "case when p_partkey % 7 = 6 then '0' else cast(100000000000 + p_partkey as string) end as upc",
            f"case when p_partkey % 7 in (0, 3) then {asin_of('p_partkey')} end as asin",
            "cast(p_size * 2 as int) as carton_qty",
            "cast(p_size * 12 as int) as avail_in_stock",
            "case when p_size % 9 > 0 then cast(p_size % 9 as int) end as wip",
            "case when p_size % 5 > 0 then cast(p_size as int) end as in_transit",
            f"cast(p_retailprice as {MONEY}) as cost",
            "case when p_size % 3 > 0 then concat('K', cast(p_size % 3 as string)) end as sku200",
            "concat('SC', cast(p_size % 4 as string)) as size_scale",
        )

    @cached_property
    def prepack(self) -> DataFrame:
        slots = []
        for i in range(1, PREPACK_SLOTS + 1):
            slots += [f"case when {i} <= 5 + division then 'S{i}' end as size_{i}",
                      f"cast(case when {i} <= 5 + division then {i} % 4 end as int) as qty_{i}"]
        return self.table("part").selectExpr(
            "cast(replace(p_brand, 'Brand#', '') as int) as division", "substring(p_type, 1, 1) as season"
        ).distinct().selectExpr(
            "division", "'PP1' as prepack_code", "season", "concat('A', season) as size_scale_1",
            "cast(null as string) as size_scale_2", "cast(null as string) as size_scale_3",
            "concat('Prepack ', season) as prepack_desc",
            "cast(case when division = 5 then 0 else 24 end as int) as total_units", *slots,
        )

    @cached_property
    def warehouse_info(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "cast(290 + s_suppkey as int) as warehouse", "s_name as name", "concat(s_name, ' Street') as address_1",
            "concat('City ', cast(s_nationkey as string)) as city_state", "'US' as country",
            "cast(10000 + s_suppkey as string) as zip_postal_code", "'USD' as currency", "'W' as whse_type",
            "'1' as company_number", "concat('L', cast(s_suppkey as string)) as warehouse_locator",
            "concat('T', cast(s_suppkey as string)) as trading_partner_id",
        )

    @cached_property
    def warehouse_override(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "cast(290 + n_nationkey as int) as warehouse",
            "case when n_regionkey = 0 then 'X' end as exclude",
            "case when n_regionkey > 1 then cast(n_regionkey as string) end as priority",
        )

    @cached_property
    def upc_sku(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(100000000000 + p_partkey as string) as upc", f"{sku_of('p_partkey')} as sku", "p_type as style"
        )

    @cached_property
    def inventory_events(self) -> DataFrame:
        return self.table("events").selectExpr(
            "concat('acct_', cast(user_id % 3 as string)) as company_name", "to_date(ts) as event_date",
            "case event_type when 'click' then 'Adjustments' when 'view' then 'Shipments' when 'purchase' then 'CustomerReturns' "
            "when 'signup' then 'VendorReturns' else 'Receipts' end as transaction_type",
            f"{asin_of('user_id')} as fnsku", f"case when event_type = 'click' then replace(lower({sku_of('user_id')}), 'k', 'ķ') else {sku_of('user_id')} end as sku",
            "concat(case when value < 10 then 'fć' else 'FC' end, cast(user_id % 5 as string)) as fulfillment_center_id",
            "cast(case when value < 20 then -1 else 1 end as int) as quantity",
            "case when value >= 40 then 'DEFECTIVE' else 'SELLABLE' end as disposition",
        )

    @cached_property
    def exported(self) -> DataFrame:
        """Ledger of settlements exported before: every settlement that ended before 1996."""
        return self.settlements.where("end_date < date'1996-01-01'").select("account_name", "settlement_id").distinct()
