"""Every job as a query over one scale-factor folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators import credits, drafts, inventory_events as events, ledger, products, quality, reconciliation, sales, stock
from ledgerloom.operators.product_match import canonical_inventory, resolve_products
from ledgerloom.params import EVENT_TYPES_SKIPPED_DRAFT, STOCK_ATTRIBUTES
from ledgerloom.plans.dataset import AS_OF, FIXTURE_LAYOUT, SETTLEMENT_COLUMNS, Dataset
from ledgerloom.sources import feeds, sinks
from ledgerloom.sources.workspace import new_dir
from ledgerloom.streaming.ingest import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

DAY = dt.date(2001, 10, 31)
# Periods of the windowed jobs.
FIRST_DAY, LAST_DAY = "1996-01-01", "2001-10-31"
EVENT_FIRST, EVENT_LAST = "2024-01-03", "2024-01-29"
BUSINESS_DAY = "1998-06-15"
PENDING_FROM = "1995-06-01"
SKUS_SINCE = "1997-01-01"
LOOKUP_DAY = "1995-03-15"


class Jobs:
    """The jobs wired to the tables of one folder, so that queries share their inputs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.data = Dataset(spark, sf_dir)
        self.matched: DataFrame | None = None

    # steps that several jobs of a batch share
    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared folder and read again. The planner then knows its size from the files."""
        path = new_dir(self.spark, name)
        sinks.full_refresh(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def batch(self, pending_only: bool = False) -> Jobs:
        """The same jobs over stored steps: the items that lines unfold from are cut finely once, and resolved products are computed once.

        Lines and channels are several times the items they come from, so they are unfolded again where they are read, and not stored.
        Of pending settlements the lines are stored, with the channels, so what each job of the batch reads shrinks with their share.
        """
        jobs = Jobs(self.spark, self.data.sf_dir)
        jobs.data.__dict__["lineitem"] = feeds.cut_finely(self.data.table("lineitem"), new_dir(self.spark, "batch-items"))
        if pending_only:
            lines = jobs.data.settlements
            pending = ledger.pending_settlements(lines, jobs.data.exported, _date(PENDING_FROM)).select("account_name", "settlement_id")
            lines = lines.join(self.kept(pending.distinct(), "batch-pending"), ["account_name", "settlement_id"], "left_semi")
            jobs.data.__dict__["settlements"] = self.kept(lines, "batch-lines")
            jobs.data.__dict__["all_orders"] = self.kept(jobs.data.all_orders, "batch-channels")
        wanted = dict.fromkeys([*sales.EXTRACT_ATTRIBUTES, *credits.EXTRACT_ATTRIBUTES])
        jobs.matched = self.kept(jobs.products(*wanted), "batch-products")
        return jobs

    # settlement side
    def lines(self) -> DataFrame:
        return ledger.ledger_lines(self.data.settlements)

    def products(self, *attributes: str) -> DataFrame:
        """Every SKU of the statements with the attributes a job needs."""
        if self.matched is not None and set(attributes) <= set(self.matched.columns):
            return self.matched
        return resolve_products(
            self.data.settlements.select("sku").distinct(), self.data.product_data, self.data.inventory, "orders", attributes=attributes)

    def orders_fba(self) -> DataFrame:
        return sales.order_rollup_fba(self.lines(), self.data.all_orders)

    def orders_fbm(self) -> DataFrame:
        return sales.order_rollup_fbm(self.lines(), self.data.all_orders)

    def sales(self, *currencies: str) -> DataFrame:
        fx = self.data.fx_rates if not currencies or "MXN" in currencies else None
        return sales.sales_extract(self.orders_fba(), self.products(*sales.EXTRACT_ATTRIBUTES), fx, currencies or None, FIXTURE_LAYOUT)

    def ranked(self) -> DataFrame:
        return ledger.duplicate_ranks(self.lines())

    def ranked_credits(self) -> DataFrame:
        """Credits with their rank: lines equal to a credit are credits, so the others need not travel to be ranked."""
        return ledger.duplicate_ranks(self.lines().where(credits.is_credit()))

    def credits(self, *currencies: str) -> DataFrame:
        fx = self.data.fx_rates if not currencies or "MXN" in currencies else None
        return credits.credit_extract(self.lines(), self.data.fee_reference, self.products(*credits.EXTRACT_ATTRIBUTES), fx, currencies or None, FIXTURE_LAYOUT)

    def recon_raw(self) -> DataFrame:
        return reconciliation.recon_raw(self.lines(), self.data.all_orders, self.data.fee_reference)

    def recon_logic(self) -> DataFrame:
        return reconciliation.recon_logic(self.lines(), self.sales(), self.orders_fbm(), self.credits())

    def skus(self) -> DataFrame:
        return ledger.settlement_skus(self.data.settlements, F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date"))

    def missing(self) -> DataFrame:
        return products.missing_upc_report(self.skus(), self.data.product_data, self.data.inventory)

    # stock side
    def prepacked(self) -> DataFrame:
        return stock.prepack_join(self.data.inventory, self.data.prepack)

    def sized(self) -> DataFrame:
        return stock.stock_by_size(self.data.inventory, self.data.prepack)

    def backfilled(self) -> DataFrame:
        return stock.size_upc_backfill(self.sized())

    def final(self) -> DataFrame:
        return stock.final_stock(self.data.inventory, self.data.prepack)

    def warehouses(self) -> DataFrame:
        return stock.warehouse_list(self.data.inventory, self.data.warehouse_override)

    def sellable(self) -> DataFrame:
        return stock.sellable_stock(self.final(), self.warehouses())

    # inventory events
    def event_ledger(self, **options: object) -> DataFrame:
        return events.inventory_event_ledger(
            self.data.inventory_events, F.lit(EVENT_FIRST).cast("date"), F.lit(EVENT_LAST).cast("date"), **options
        )

    def event_products(self) -> DataFrame:
        d = self.data
        return resolve_products(d.inventory_events.select("sku").distinct(), d.product_data, d.inventory, "inventory", d.inventory_events)

    def converted_events(self) -> DataFrame:
        return events.inventory_adjustment_conversion(self.event_ledger(), self.event_products())

    def draft_event_ledger(self) -> DataFrame:
        return self.event_ledger(skipped=EVENT_TYPES_SKIPPED_DRAFT)

    def draft_event_products(self) -> DataFrame:
        return drafts.event_products(self.data.inventory_events, self.data.product_data, self.data.inventory)

    # drafts
    def draft_products(self, *attributes: str, variant: str = "two_rung") -> DataFrame:
        return resolve_products(
            self.data.statements.select("sku").distinct(), self.data.product_data, self.data.inventory, variant, attributes=attributes)

    def buckets(self) -> DataFrame:
        return drafts.order_buckets(drafts.open_lines(self.data.statements), self.data.all_orders)

    def draft_credits(self) -> DataFrame:
        # as in ranked_credits
        return drafts.credit_rollup_line_grain(drafts.draft_ledger(self.data.statements.where(drafts.line_grain_credit())))

    # round trips through files
    def round_trip(self, df: DataFrame, name: str, partitions: list[str], order: list[str], then: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Packed, as the text is several times the lines; each file is read whole by one task anyway."""
        path, whole = new_dir(self.spark, name), then(df) if then else df
        sinks.export_partitioned(df, path, partitions, order, packed="gzip", then=then)
        return feeds.read_csv(self.spark, path, whole.schema).select(*whole.columns)

    def csv_trip(self, df: DataFrame, name: str, order: list[str] | None = None) -> DataFrame:
        path = new_dir(self.spark, name)
        sinks.export_csv(df, path, order)
        return feeds.read_csv(self.spark, path, df.schema)


def _date(text: str):
    return F.lit(text).cast("date")


QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Jobs], DataFrame]], Callable[[Jobs], DataFrame]]:
    def register(job: Callable[[Jobs], DataFrame]) -> Callable[[Jobs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: job(Jobs(spark, sf_dir))
        return job

    return register


def _register(jobs: dict[str, Callable[[Jobs], DataFrame]]) -> None:
    for name, job in jobs.items():
        query(name)(job)


_register({
    # ledger
    "dup_rank": lambda j: j.ranked(),
    "settlement_line_id": lambda j: ledger.line_numbers(j.ranked().select("account_name", "settlement_id", *ledger.LEDGER_ORDER)).select(
        "id", "account_name", "settlement_id", *ledger.LEDGER_ORDER),
    "fee_ledger": lambda j: ledger.fee_ledger(j.data.settlements, j.data.fee_reference),
    "join_null_blank": lambda j: ledger.join_null_blank(j.lines(), j.data.fee_reference).select(
        "account_name", "settlement_id", "order_id", "sku", "transaction_type", "fee_category", "fee_type", "amount", "id", "class_code"),
    "raw_settlement_extract": lambda j: ledger.raw_settlement_extract(j.data.settlements, j.data.fee_reference),
    "settlement_skus": lambda j: j.skus(),
    "settlement_period": lambda j: ledger.settlement_period(j.lines()),
    "settlement_calendar": lambda j: ledger.settlement_calendar(j.data.settlements),
    "pending_settlements": lambda j: ledger.pending_settlements(j.data.settlements, j.data.exported, _date(PENDING_FROM)),
    "fee_reference_refresh": lambda j: ledger.fee_reference_refresh(j.data.settlements, j.data.fee_reference),
    "check_unique_keys": lambda j: ledger.check_unique_keys(j.data.all_orders, ["order_id", "sku", "fulfillment_channel"]),
    "check_single_period": lambda j: ledger.check_single_period(j.lines()),
    # product match
    "inventory_by_upc": lambda j: canonical_inventory(j.data.inventory),
    "listing_upc_backfill": lambda j: products.listing_upc_backfill(j.data.product_data, j.data.all_listings),
    "missing_upc_report": lambda j: j.missing(),
    "upc_match_rungs": lambda j: products.upc_match_rungs(j.products()),
    "upc_match_diagnostic": lambda j: products.upc_match_diagnostic(
        j.data.settlements.select("sku").distinct(), j.data.product_data, j.data.inventory, j.data.inventory_events),
    "related_products_by_asin": lambda j: products.related_products_by_asin(j.data.product_data, j.buckets()),
    # sales
    "order_rollup_fba": lambda j: j.orders_fba(),
    "order_rollup_fbm": lambda j: j.orders_fbm(),
    "order_enriched": lambda j: sales.order_enriched(j.orders_fba(), j.products(*STOCK_ATTRIBUTES)),
    "sales_extract_usd": lambda j: j.sales("USD"),
    "sales_extract_cad": lambda j: j.sales("CAD"),
    "sales_extract_mxn": lambda j: j.sales("MXN"),
    "sales_connected_split": lambda j: sales.sales_connected_split(j.sales()),
    # credits
    "credit_rollup": lambda j: credits.credit_rollup(j.ranked_credits()),
    "credit_enriched": lambda j: credits.credit_enriched(credits.credit_rollup(j.ranked_credits()), j.products(*STOCK_ATTRIBUTES)),
    "credit_extract_usd": lambda j: j.credits("USD"),
    "credit_extract_cad": lambda j: j.credits("CAD"),
    "credit_extract_mxn": lambda j: j.credits("MXN"),
    "credit_connected_split": lambda j: credits.credit_connected_split(j.credits()),
    # reconciliation
    "recon_raw": lambda j: j.recon_raw(),
    "recon_logic": lambda j: j.recon_logic(),
    # stock
    "prepack_join": lambda j: j.prepacked(),
    "prepack_size_explode": lambda j: stock.prepack_size_explode(j.prepacked()),
    "loose_stock_rows": lambda j: stock.loose_stock_rows(j.prepacked()),
    "size_upc_backfill": lambda j: j.backfilled(),
    "prepack_prune": lambda j: stock.prepack_prune(j.backfilled()),
    "stock_per_size": lambda j: j.final(),
    "warehouse_list": lambda j: j.warehouses(),
    "sellable_stock": lambda j: j.sellable(),
    "style_upc_lookup": lambda j: stock.style_upc_lookup(j.sellable()),
    "distinct_styles": lambda j: stock.distinct_styles(j.sellable()),
    # inventory events
    "inventory_event_rank": lambda j: events.inventory_event_rank(j.data.inventory_events),
    "inventory_event_ledger": lambda j: j.event_ledger(),
    "inventory_adjustment_conversion": lambda j: j.converted_events(),
    "inventory_adjustment_extract": lambda j: events.inventory_adjustment_extract(j.converted_events()),
    # drafts
    "daily_principal_total": lambda j: drafts.daily_principal_total(j.data.statements, _date(AS_OF)),
    "duplicate_lines": lambda j: drafts.duplicate_lines(j.data.statements, _date(AS_OF)),
    "order_buckets": lambda j: j.buckets(),
    "two_rung_match": lambda j: drafts.two_rung_match(j.buckets(), j.draft_products(*drafts.MERGED_ATTRIBUTES)),
    "order_extract_order_grain": lambda j: drafts.order_extract_order_grain(drafts.two_rung_match(j.buckets(), j.draft_products(*drafts.MERGED_ATTRIBUTES))),
    "order_extract_with_division": lambda j: drafts.order_extract_order_grain(
        drafts.attach_products(j.buckets(), resolve_products(
            j.data.statements.select("sku").distinct(), j.data.product_data, j.data.inventory, "inventory", j.data.inventory_events),
            drafts.MERGED_ATTRIBUTES), with_division=True),
    "sku_match_list": lambda j: drafts.sku_match_list(j.draft_products(variant="two_rung_any_channel")),
    "sku_match_list_since": lambda j: drafts.sku_match_list(resolve_products(
        drafts.skus_since(j.data.statements, _date(SKUS_SINCE)), j.data.product_data, j.data.inventory, "two_rung_any_channel", attributes=())),
    "recent_order_principals": lambda j: drafts.recent_order_principals(j.data.statements, _date(AS_OF)),
    "settlement_day_lookup": lambda j: drafts.settlement_day_lookup(j.data.statements, j.data.exported.select("settlement_id"), _date(LOOKUP_DAY)),
    "orders_without_channel": lambda j: drafts.orders_without_channel(j.buckets()),
    "credit_rollup_line_grain": lambda j: j.draft_credits(),
    "credit_extract_line_grain": lambda j: drafts.credit_extract_line_grain(j.draft_credits(), j.draft_products("division", "sub_div", "season", "style", "color")),
    "refund_rollup": lambda j: drafts.refund_rollup(drafts.open_lines(j.data.statements)),
    "refund_extract": lambda j: drafts.refund_extract(drafts.refund_rollup(drafts.open_lines(j.data.statements)), j.draft_products(*drafts.MERGED_ATTRIBUTES)),
    "refund_lines_open": lambda j: drafts.refund_lines_open(j.data.statements, _date(AS_OF)),
    "mark_orders_by_status_rungs": lambda j: drafts.mark_complete(drafts.open_lines(j.data.statements), j.draft_products(variant="status")),
    "mark_complete": lambda j: drafts.mark_complete(drafts.open_lines(j.data.statements), j.draft_products()),
    "mark_events_complete": lambda j: drafts.mark_events_complete(j.draft_event_ledger(), j.draft_event_products()),
    "stock_adjustment_draft": lambda j: drafts.stock_adjustment_draft(j.draft_event_ledger(), j.draft_event_products()),
    "local_day_totals": lambda j: drafts.local_day_totals(j.data.statements, _date(BUSINESS_DAY)),
    "local_day_ledger": lambda j: drafts.local_day_ledger(j.data.statements, _date(BUSINESS_DAY), _date(BUSINESS_DAY)),
    "settlement_day_total": lambda j: drafts.settlement_day_total(j.data.statements, _date(BUSINESS_DAY)),
    "zone_comparison": lambda j: drafts.zone_comparison(j.data.statements, _date(BUSINESS_DAY)),
    "statement_discrepancy": lambda j: drafts.statement_discrepancy(j.data.statement_lines),
    "order_lookup": lambda j: drafts.order_lookup(
        j.data.settlements, j.data.table("orders").where("o_orderpriority = '1-URGENT'").select(F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("order_id"))),
    "order_sku_representative": lambda j: drafts.order_sku_representative(j.data.statements, _date(AS_OF)),
    # quality
    "profile_number_texts": lambda j: quality.profile_column_types(j.data.table("part").selectExpr(
        "case p_partkey % 3 when 0 then '.5' when 1 then '1e3' else ' 7' end as spellings", "case p_partkey % 2 when 0 then '12345.6' else '1.2345' end as mixed",
        "case when p_partkey % 50 = 1 then '12345678901234567890.5' else '1' end as long_number", "'007' as padded",
        "case p_partkey % 2 when 0 then '-3.10' else '2' end as signed", "case when p_partkey % 4 = 0 then 'x1' else cast(p_partkey as string) end as words")),
    "profile_wide_numbers": lambda j: quality.profile_column_types(j.data.table("part").selectExpr(
        "concat('1234567890123456789012345', lpad(cast(p_partkey as string), 6, '0')) as thirty_digits", "cast(p_partkey as double) * 1e40 as huge",
        "concat(cast(p_partkey as string), 'e40') as huge_text", "concat('-', repeat('9', 29), '.25') as wide_fraction", "repeat('7', 45) as too_wide",
        "case when p_partkey % 2 = 0 then double('NaN') else 0.5D end as halves")),
    # one state per currency, as if they were deliveries, and their merge
    "profile_merged": lambda j: quality.profile_types(quality.merge_states(reduce(DataFrame.unionByName, [
        quality.profile_state(j.data.settlements.where(F.col("currency") == c)) for c in ("USD", "CAD", "MXN")]))),
    "profile_column_types": lambda j: quality.profile_column_types(j.data.settlements),
    "schema_missing_columns": lambda j: quality.schema_missing_columns(
        quality.profile_column_types(j.data.settlements), quality.profile_column_types(j.data.statements)),
    "schema_widening_plan": lambda j: quality.schema_widening_plan(
        quality.profile_column_types(j.data.warehouse_info).select("column_name", F.col("target_type").alias("stored_type")),
        quality.profile_column_types(j.data.inventory.select(
            "warehouse", F.col("warehouse_name").alias("name"), F.col("asin").alias("zip_postal_code"),
            F.col("cost").alias("company_number"), F.col("upc").alias("trading_partner_id")))),
    "normalize_headers": lambda j: quality.normalize_headers(quality.title_headers(j.data.warehouse_info)),
    "null_normalize": lambda j: quality.null_normalize(j.data.inventory),
})


@query("recon_report")
def _recon_report(j: Jobs) -> DataFrame:
    """Both sides stored per settlement; one account's settlements are then replaced in the stored table, which changes nothing."""
    jobs = j.batch()
    report = j.kept(reconciliation.recon_report(jobs.recon_raw(), jobs.recon_logic()), "reconciliation-run")
    path, keys = new_dir(j.spark, "reconciliation"), ["account_name", "settlement_id"]
    for changed in (report, report.where("account_name = 'acct_1'")):
        sinks.replace_keys(changed, changed, path, keys)
    return sinks.read_keyed(j.spark, path, report.schema).orderBy("settlement_id", "type")


@query("reconciliation_shrinks")
def _reconciliation_shrinks(j: Jobs) -> DataFrame:
    """Raw side stored per settlement, some without an account; a second run in which settlements in pesos yield nothing removes their rows."""
    account = F.when(F.col("settlement_id") % 3 > 0, F.col("account_name")).alias("account_name")
    raw = j.recon_raw()
    raw = j.kept(raw.select(*[account if c == "account_name" else c for c in raw.columns]), "raw-side")
    path, keys = new_dir(j.spark, "raw-side-stored"), ["account_name", "settlement_id"]
    pesos = raw.where("settlement_id % 10 = 2")
    for changed, touched in ((raw, raw), (pesos.where("false"), pesos)):
        sinks.replace_keys(changed, touched, path, keys)
    return sinks.read_keyed(j.spark, path, raw.schema)


@query("pending_from_files")
def _pending_from_files(j: Jobs) -> DataFrame:
    """Pending settlements, the exported ones taken from the names of the files they were exported to."""
    folder = new_dir(j.spark, "statements")
    sinks.export_statements(j.data.settlements.where("end_date < date'1996-01-01'"), folder)
    exported = feeds.exported_statements(j.spark, folder)
    return ledger.pending_settlements(j.data.settlements, exported, _date(PENDING_FROM))


@query("pending_lines")
def _pending_lines(j: Jobs) -> DataFrame:
    """Lines of the pending settlements, out of statements stored by month: the list of pending ones prunes the scan."""
    path = new_dir(j.spark, "statements-by-month")
    sinks.store_statements(j.data.settlements, path)
    stored = sinks.read_statements(j.spark, path, j.data.settlements.schema)
    kept = Jobs(j.spark, j.data.sf_dir)
    kept.data.__dict__["settlements"] = stored.select(*SETTLEMENT_COLUMNS)  # the exported ones are listed from the stored lines too
    pending = ledger.pending_settlements(stored, kept.data.exported, _date(PENDING_FROM))
    months = j.kept(ledger.settlement_months(stored, pending), "pending-months")
    return ledger.lines_of(stored, months).select(*SETTLEMENT_COLUMNS)


@query("exported_from_files")
def _exported_from_files(j: Jobs) -> DataFrame:
    """Account, settlement and period of every settlement exported so far, from file names alone."""
    folder = new_dir(j.spark, "statements")
    sinks.export_statements(j.data.settlements.where("end_date < date'1996-01-01'").select("account_name", "settlement_id", "start_date", "end_date", "posted_date", "order_id", "sku"), folder)
    return feeds.exported_statements(j.spark, folder)


@query("check_keyed_inputs")
def _check_keyed_inputs(j: Jobs) -> DataFrame:
    """Keys of every keyed input that are null or repeated, as text."""
    d = j.data
    inputs = {
        "all_orders": (d.all_orders, ["order_id", "sku", "fulfillment_channel"]), "exchange_rates": (d.fx_rates, ["settlement_id"]),
        "prepack": (d.prepack, ["division", "prepack_code", "season"]), "warehouse_override": (d.warehouse_override, ["warehouse"]),
        "product_data": (d.product_data, ["account_name", "sku"]), "fee_reference": (d.fee_reference, ["transaction_type", "fee_category", "fee_type"]),
    }
    reports = []
    for name, (df, keys) in inputs.items():
        text = F.concat_ws("|", *[F.coalesce(F.lower(F.col(k).cast("string")), F.lit("")) for k in keys])
        bad = ledger.check_unique_keys(df, keys)
        reports.append(bad.select(F.lit(name).alias("input"), text.alias("key_text"), "key_count"))
    return reduce(DataFrame.unionByName, reports)


@query("feed_rejects")
def _feed_rejects(j: Jobs) -> DataFrame:
    """An override feed with shuffled columns and a letter in some warehouse numbers: what parses and what does not."""
    path = new_dir(j.spark, "override")
    feed = j.data.warehouse_override.selectExpr(
        "priority", "case when warehouse % 4 = 0 then concat(warehouse, 'A') else cast(warehouse as string) end as WAREHOUSE", "exclude")
    sinks.export_csv(feed, path)
    rows, rejects = feeds.read_feed(j.spark, path, feeds.OVERRIDE_SCHEMA)
    good = rows.selectExpr("'' as faults", "exclude", "priority", "warehouse")
    bad = rejects.selectExpr("faults", "from_json(record, 'exclude string, priority string, WAREHOUSE string') as r")
    return good.unionByName(bad.selectExpr("faults", "r.exclude", "r.priority", "cast(replace(r.WAREHOUSE, 'A', '') as int) as warehouse"))


def _faulty_stock(j: Jobs) -> feeds.Feed:
    """The stock feed with letters in numbers, prices that are none, rows cut short and rows with a value too many."""
    folder = new_dir(j.spark, "faulty-stock")
    columns = j.spark.createDataFrame([], feeds.INVENTORY_SCHEMA).columns
    shown = {"carton_qty": "case when carton_qty % 14 = 0 then concat(carton_qty, ' pcs') else cast(carton_qty as string) end",
             "cost": "case when carton_qty % 22 = 0 then 'n/a' else cast(cost as string) end"}
    values = [f"coalesce({shown.get(c, f'cast({c} as string)')}, '')" for c in columns]
    whole, short = (f"concat_ws('|', {', '.join(part)})" for part in (values, values[:-2]))
    lines = j.data.inventory.selectExpr(f"case when avail_in_stock % 156 = 0 then {short} when avail_in_stock % 204 = 0 then concat({whole}, '|more') else {whole} end as value")
    # a separator and a quote that no text holds leave the lines as they are; the column's name becomes the header
    lines.toDF("|".join(columns)).write.options(header="true", sep="\u0001", quote="\u0000", ignoreTrailingWhiteSpace="false").csv(f"{folder}/feed")
    return feeds.load_feed(j.spark, f"{folder}/feed", feeds.INVENTORY_SCHEMA, "|", max_share=1.0)


query("feed_fault_counts")(lambda j: _faulty_stock(j).counted())
query("feed_rejected_rows")(lambda j: _faulty_stock(j).rejects.groupBy("faults").agg(F.count("*").alias("rows")))
query("feed_sound_rows")(lambda j: _faulty_stock(j).rows)


@query("sink_full_refresh")
def _sink_full_refresh(j: Jobs) -> DataFrame:
    path = new_dir(j.spark, "settlements")
    sinks.full_refresh(j.data.settlements, path)
    return feeds.read_table(j.spark, path)


@query("export_sales_files")
def _export_sales_files(j: Jobs) -> DataFrame:
    split = ledger.with_period_label(sales.sales_connected_split(j.sales()), j.lines())
    return j.round_trip(split, "sales", ["account_name", "settlement_id", "period", "currency", "connected"], sinks.FILE_ORDER["sales"])


@query("export_credit_files")
def _export_credit_files(j: Jobs) -> DataFrame:
    split = ledger.with_period_label(credits.credit_connected_split(j.credits()), j.lines())
    return j.round_trip(split, "credits", ["account_name", "settlement_id", "period", "currency", "connected"], sinks.FILE_ORDER["credits"])


@query("export_fbm_files")
def _export_fbm_files(j: Jobs) -> DataFrame:
    orders = ledger.with_period_label(sales.merchant_export(j.orders_fbm()), j.lines())
    return j.round_trip(orders, "merchant", ["account_name", "settlement_id", "period", "currency"], ["order_id", "sku"])


@query("export_inventory_adjustments")
def _export_inventory_adjustments(j: Jobs) -> DataFrame:
    extract = events.inventory_adjustment_extract(j.converted_events())
    return j.round_trip(extract, "adjustments", ["connected"], sinks.FILE_ORDER["adjustments"])


@query("export_raw_settlement")
def _export_raw_settlement(j: Jobs) -> DataFrame:
    # the reference joins lines that lie where they are written
    return j.round_trip(j.data.settlements, "raw", ["account_name", "settlement_id"], ["posted_date", "order_id", "sku"],
                        then=lambda lines: ledger.raw_settlement_extract(lines, j.data.fee_reference))


_register({
    "export_missing_upc": lambda j: j.csv_trip(j.missing(), "missing-upc", ["sku"]),
    "export_inventory": lambda j: j.csv_trip(j.sellable(), "inventory"),
    "export_upcs": lambda j: j.csv_trip(stock.style_upc_lookup(j.sellable()), "upcs"),
    "export_warehouses": lambda j: j.csv_trip(j.warehouses(), "warehouses", ["priority", "warehouse"]),
    "export_warehouse_addresses": lambda j: j.csv_trip(j.data.warehouse_info, "addresses", ["warehouse"]),
    "export_styles": lambda j: j.csv_trip(stock.distinct_styles(j.sellable()), "styles"),
})


@query("export_reconciliation")
def _export_reconciliation(j: Jobs) -> DataFrame:
    jobs = j.batch()
    return j.csv_trip(reconciliation.recon_report(jobs.recon_raw(), jobs.recon_logic()), "recon", ["settlement_id", "type"])


# feeds: the derived table is written as the feed delivers it and read back


@query("src_inventory_feed")
def _src_inventory_feed(j: Jobs) -> DataFrame:
    folder = new_dir(j.spark, "feed")
    schema = j.spark.createDataFrame([], feeds.INVENTORY_SCHEMA).columns
    sinks.export_csv(j.data.inventory.select(*schema), f"{folder}/{feeds.dated(feeds.INVENTORY_STEM, DAY)}.csv", separator="|")
    return feeds.read_inventory_feed(j.spark, folder, DAY)


@query("src_statements_in_blocks")
def _src_statements_in_blocks(j: Jobs) -> DataFrame:
    """Statement lines whose descriptions hold line breaks and quotes, from files that several tasks may read."""
    path = new_dir(j.spark, "feed")
    j.data.__dict__["lineitem"] = feeds.cut_finely(j.data.table("lineitem"), new_dir(j.spark, "items"))
    lines = j.data.settlements.select(*SETTLEMENT_COLUMNS)
    noted = lines.withColumn("amount_description", F.concat("amount_description", F.lit('\n"'), F.coalesce("order_id", F.lit("")), F.lit('",')))
    sinks.export_csv(noted, path, packed="bzip2")  # as text a feed is several times the tables it comes from
    return feeds.load_feed(j.spark, path, feeds.SETTLEMENT_SCHEMA, in_blocks=True).rows


@query("src_prepack_feed")
def _src_prepack_feed(j: Jobs) -> DataFrame:
    folder = new_dir(j.spark, "feed")
    sinks.export_csv(j.data.prepack, f"{folder}/{feeds.dated(feeds.PREPACK_STEM, DAY)}.csv", separator="|")
    return feeds.read_prepack_feed(j.spark, folder, DAY)


@query("src_upc_sku")
def _src_upc_sku(j: Jobs) -> DataFrame:
    folder = new_dir(j.spark, "feed")
    sinks.export_csv(j.data.upc_sku, f"{folder}/{feeds.dated(feeds.UPC_SKU_STEM, DAY)}.csv")
    return feeds.read_upc_sku(j.spark, folder, DAY)


@query("src_warehouse_info")
def _src_warehouse_info(j: Jobs) -> DataFrame:
    folder = new_dir(j.spark, "feed")
    sinks.export_csv(quality.title_headers(j.data.warehouse_info), f"{folder}/{feeds.WAREHOUSE_STEM}.csv")
    return feeds.read_warehouse_info(j.spark, folder)


@query("src_warehouse_override")
def _src_warehouse_override(j: Jobs) -> DataFrame:
    folder = new_dir(j.spark, "feed")
    sinks.export_csv(j.data.warehouse_override, f"{folder}/{feeds.OVERRIDE_FILE}")
    return feeds.read_warehouse_override(j.spark, folder)


@query("src_fee_reference")
def _src_fee_reference(j: Jobs) -> DataFrame:
    """The reference extended by the fee keys of the statements, stored as CSV and read back."""
    path = new_dir(j.spark, "fee-reference")
    sinks.export_csv(ledger.fee_reference_refresh(j.data.settlements, j.data.fee_reference), path)
    return feeds.read_fee_reference(j.spark, path)


@query("src_fx_rates")
def _src_fx_rates(j: Jobs) -> DataFrame:
    path = new_dir(j.spark, "fx")
    sinks.export_csv(quality.title_headers(j.data.fx_rates), path)
    return feeds.read_fx_rates(j.spark, path)


@query("union_store_codes")
def _union_store_codes(j: Jobs) -> DataFrame:
    """A sheet per market segment; two of them lack a column the others have."""
    folder = new_dir(j.spark, "stores")
    customers = j.data.table("customer").selectExpr(
        "c_mktsegment as store", "cast(c_custkey as string) as code", "c_name as name", "cast(c_nationkey as string) as region")
    for lacking, sheets in (("region", "store = 'AUTOMOBILE'"), ("name", "store = 'BUILDING'"), ("", "store not in ('AUTOMOBILE', 'BUILDING')")):
        sinks.export_partitioned(customers.where(sheets).drop(lacking), f"{folder}/{lacking or 'all'}", ["store"], ["code"])
    return feeds.union_sheets(j.spark, folder, ["code", "name", "region"], F.regexp_extract("path", "store=([^/]+)/", 1))


@query("ingest_new_files")
def _ingest_new_files(j: Jobs) -> DataFrame:
    """Statements arrive in two deliveries; three runs pick every file up once."""
    folder = new_dir(j.spark, "ingest")
    lines = j.data.settlements.select(*SETTLEMENT_COLUMNS)
    arrivals = (lines.where("year(end_date) < 1998"), lines.where("year(end_date) >= 1998"))
    for arrival in arrivals:
        # packed, as a delivery; each file is read whole by one task anyway
        arrival.write.mode("append").options(**feeds.CSV_WRITE).option("compression", "gzip").csv(f"{folder}/incoming")
        ingest_new_files(j.spark, f"{folder}/incoming", feeds.SETTLEMENT_SCHEMA, f"{folder}/landing", f"{folder}/checkpoint")
    ingest_new_files(j.spark, f"{folder}/incoming", feeds.SETTLEMENT_SCHEMA, f"{folder}/landing", f"{folder}/checkpoint")
    return j.spark.read.schema(feeds.SETTLEMENT_SCHEMA).parquet(f"{folder}/landing")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pending settlements of all accounts at once: both reconciliation sides with their difference."""
    jobs = Jobs(spark, sf_dir).batch(pending_only=True)
    return reconciliation.recon_report(jobs.recon_raw(), jobs.recon_logic())


QUERIES["reconcile_pending"] = flagship


__all__ = ["QUERIES", "Jobs", "flagship"]
