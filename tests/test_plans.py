"""What holds for the jobs as a whole: no work while a plan is built, sums that add up, sorted results."""

import os
import pathlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from ledgerloom.operators import ledger, reconciliation
from ledgerloom.plans.registry import QUERIES, Jobs
from ledgerloom.sources import sinks
from ledgerloom.sources.feeds import cut_finely, dealt_out
from ledgerloom.sources.workspace import shared_dir

FOLDER = os.environ.get("LEDGERLOOM_TESTDATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables not present")


@pytest.mark.parametrize("name", ["dup_rank", "credit_rollup", "prepack_join", "sellable_stock", "warehouse_list", "sales_extract_mxn", "credit_extract_mxn",
                                  "recon_raw", "recon_logic", "fee_reference_refresh", "refund_rollup", "duplicate_lines", "profile_column_types"])
def test_building_a_query_runs_nothing(spark, monkeypatch, name):
    def refuse(*_, **__):
        raise AssertionError("the plan looked at the data")

    for action in ("collect", "first", "head", "take", "count", "isEmpty", "toLocalIterator", "toArrow", "toPandas", "foreach", "checkpoint"):
        monkeypatch.setattr(DataFrame, action, refuse)
    monkeypatch.setattr(DataFrame, "rdd", property(refuse))
    monkeypatch.setattr(DataFrame, "write", property(refuse))
    assert QUERIES[name](spark, FOLDER).columns


def test_statement_lines_are_scanned_once_in_a_batch(spark):
    jobs = Jobs(spark, FOLDER).batch(pending_only=True)
    plan = reconciliation.recon_report(jobs.recon_raw(), jobs.recon_logic())._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "l_partkey" not in plan


def _files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().executedPlan()
    while plan.nodeName().startswith("ResultQueryStage"):
        plan = plan.plan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if leaves.apply(i).nodeName().startswith("Scan parquet")]
    return sum(scan.metrics().apply("numFiles").value() for scan in scans)


def test_pending_settlements_prune_the_stored_months(spark, tmp_path):
    lines = Jobs(spark, FOLDER).data.settlements
    path, listed = str(tmp_path / "stored"), tmp_path / "months"
    sinks.store_statements(lines.withColumn("end_date", F.when(F.col("settlement_id") % 50 != 0, F.col("end_date"))), path)
    stored = sinks.read_statements(spark, path, lines.schema)
    ids = [r[0] for r in stored.select("settlement_id").distinct().orderBy("settlement_id").collect()]
    files = len(list((tmp_path / "stored").glob("*/*.parquet")))
    read = []
    # the last ones hold settlements without an end date
    for n, wanted in enumerate((ids[:2], ids[: len(ids) // 3], ids, [i for i in ids if i % 50 == 0])):
        chosen = stored.where(F.col("settlement_id").isin(wanted))
        ledger.settlement_months(stored, chosen).write.parquet(f"{listed}{n}")
        found = ledger.lines_of(stored, spark.read.parquet(f"{listed}{n}"))
        read.append(_files_read(found))
        assert found.count() == chosen.count() > 0
    assert read[0] <= 4 and read[0] <= read[1] <= read[2] == files and read[3] < files
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_both_sides_agree_but_for_liquidations_rates_and_rounding(spark):
    """Nothing is lost: a statement's total stands, and orders, tax and credits come out the same on both sides."""
    jobs = Jobs(spark, FOLDER).batch()
    raw, logic = jobs.recon_raw(), jobs.recon_logic()
    keys = ["account_name", "settlement_id"]
    about = jobs.data.settlements.groupBy(*keys).agg(
        F.sum("amount").alias("amount"), F.sum("quantity_purchased").alias("units"), F.count_if(F.expr("transaction_type like 'Liquidations%'")).alias("sold_off"), F.min("currency").alias("currency"))
    about = {(r["account_name"], r["settlement_id"]): r for r in about.collect()}
    sides = {side: {(r["account_name"], r["settlement_id"]): r for r in df.collect()} for side, df in (("raw", raw), ("logic", logic))}
    assert set(sides["raw"]) == set(sides["logic"]) == set(about)
    compared = 0
    for key, row in sides["raw"].items():
        assert row["total_amount"] == about[key]["amount"]
        # liquidations are sold as orders, but are none in the statement's buckets; pesos are converted
        if about[key]["sold_off"] or about[key]["currency"] == "MXN":
            continue
        compared += 1
        for bucket in reconciliation.BUCKETS:
            # a unit price is rounded to cents before orders of one price are added up
            slack = Decimal("0.01") * (about[key]["units"] or 0) if bucket.startswith("fba_orders") else 0
            assert abs(row[bucket] - sides["logic"][key][bucket]) <= slack, (key, bucket)
    assert compared > 50


@pytest.mark.parametrize("name, order", [
    ("missing_upc_report", ["sku"]), ("pending_settlements", ["account_name", "end_date", "settlement_id"]), ("recon_report", ["settlement_id", "type"]),
    ("inventory_adjustment_extract", ["division", "style", "color_code"]),
])
def test_reports_are_sorted(spark, name, order):
    rows = [tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in order) for r in QUERIES[name](spark, FOLDER).collect()]
    assert rows == sorted(rows) and rows


def test_files_are_sorted_inside(spark, tmp_path):
    df = spark.range(400).select((F.col("id") % 3).alias("p"), (F.col("id") * 7919 % 401).alias("n"), F.lit(None).cast("string").alias("t")).repartition(7)
    sinks.export_partitioned(df, str(tmp_path / "out"), ["p"], ["n"])
    files = list((tmp_path / "out").glob("p=*/*.csv"))
    assert files
    for file in files:
        numbers = [int(line.split(",")[0]) for line in file.read_text().splitlines()[1:]]
        assert numbers == sorted(numbers)


@pytest.mark.parametrize("name", ["raw_settlement_extract", "join_null_blank"])
def test_lines_are_not_shuffled_to_meet_the_fee_reference(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["credit_rollup", "credit_rollup_line_grain"])
def test_only_credits_travel_to_be_ranked(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan.index("RepartitionByExpression [_dealt")
    assert "Contains(" in plan[dealt:plan.index("RepartitionByExpression [l_", dealt) if "RepartitionByExpression [l_" in plan[dealt:] else None]


def test_raw_side_parts_its_buckets_after_adding_up_the_orders(spark):
    """Channels and currencies are told apart on a few sums per settlement: no bucket is among the sums taken over the orders."""
    jobs = Jobs(spark, FOLDER)
    plan = jobs.recon_raw()._jdf.queryExecution().optimizedPlan().toString()
    assert [line for line in plan.splitlines() if "Aggregate [account_name" in line and "fulfillment_channel" in line.split("], [")[0]]


@pytest.mark.parametrize("name", ["profile_column_types", "profile_merged"])
def test_profiles_add_up_cells_per_column(spark, name):
    """Aggregates side by side for every column are a method too long to be compiled."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    cells = [line for line in plan.splitlines() if "Aggregate [_column" in line]
    assert len(cells) == (3 if name == "profile_merged" else 1)
    assert plan.count("regexp_extract") + plan.count("RLIKE") <= 8 * len(cells)


def test_deliveries_to_ingest_are_packed(spark):
    def files():
        return set(pathlib.Path(shared_dir(spark)).glob("ingest-*/incoming/part-*"))

    before = files()
    QUERIES["ingest_new_files"](spark, FOLDER)
    new = files() - before
    assert new and all(f.name.endswith(".csv.gz") for f in new)


def test_orders_looked_up_are_told_by_a_map_of_hashes_first(spark):
    plan = QUERIES["order_lookup"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2 and "bit_or" in plan and "strategy=broadcast" in plan


def test_a_finely_cut_table_is_read_as_it_lies(spark, tmp_path):
    def dealt(df, **options):
        plan = dealt_out(df, **options)._jdf.queryExecution().optimizedPlan().toString()
        return "Repartition" in plan

    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    # as many files as cores; small files would share tasks, so their opening counts for nothing
    spark.range(1000).repartition(2 * spark.sparkContext.defaultParallelism).write.parquet(str(tmp_path / "many"))
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        one, many = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "many"))
        assert dealt(one) and not dealt(many) and dealt(many, rows_a_task=50)
        assert sorted(r[0] for r in dealt_out(one).collect()) == sorted(r[0] for r in dealt_out(many).collect()) == list(range(1000))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_lines_are_dealt_by_their_order_and_not_sorted_to_be_dealt_in_turn(spark):
    plan = _optimized(Jobs(spark, FOLDER).data.settlements)
    assert [line for line in plan if "RepartitionByExpression [l_orderkey" in line] and not [line for line in plan if "Repartition " in line]
    rows = spark.range(100).selectExpr("cast(null as bigint) as a", "id % 3 as b", "id")
    assert rows.repartition(4, "a", "b").count() == 100


@pytest.mark.parametrize("name", ["credit_extract_mxn", "sales_extract_mxn"])
def test_facts_meet_the_product_list_as_they_are(spark, name):
    """No sums per SKU, which are about as many as the facts, are shuffled before the join; the join's own exchanges can be split."""
    df = QUERIES[name](spark, FOLDER)
    keys = [line.split("Aggregate [", 1)[1].split("], [")[0] for line in _optimized(df) if "Aggregate [account_name" in line]
    assert keys and not [k for k in keys if "sku" in k and "order_id" not in k]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_sku_key") == 2


def test_spellings_of_an_order_travel_as_one_row_to_the_raw_side(spark):
    plan = _optimized(Jobs(spark, FOLDER).recon_raw())
    assert [line for line in plan if "Join LeftOuter" in line and "(_order#" in line and "(_sku#" in line and "translate" not in line]


def test_channel_keys_are_made_distinct_once(spark):
    plan = _optimized(QUERIES["order_rollup_fba"](spark, FOLDER))
    assert len([line for line in plan if "Aggregate [order_key" in line]) == 1


def test_exported_settlements_are_listed_from_the_stored_lines(spark, monkeypatch):
    kept = []
    store = sinks.full_refresh

    def seen(df, path):
        kept.append(df._jdf.queryExecution().optimizedPlan().toString())
        store(df, path)

    monkeypatch.setattr(sinks, "full_refresh", seen)
    QUERIES["pending_lines"](spark, FOLDER)
    assert len(kept) == 1 and "l_shipdate" not in kept[0]


def test_a_table_read_many_times_is_cut_once_in_its_order(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    spark.conf.set("spark.sql.files.openCostInBytes", "1m")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        cut = cut_finely(one, str(tmp_path / "cut"), rows_a_task=200)
        assert "Repartition" not in "".join(_optimized(cut)) and cut.schema == one.schema
        rows = cut.select("id", F.input_file_name().alias("file"), F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.id for r in rows) == list(range(1000))
    files = {}
    for r in rows:
        files.setdefault(r.file, []).append(r.id)
    assert all(len(ids) <= 50 and ids == list(range(ids[0], ids[0] + len(ids))) for ids in files.values())
    assert max(sum(r.task == task for r in rows) for task in {r.task for r in rows}) <= 200


@pytest.mark.parametrize("pending_only", [False, True])
def test_a_batch_deals_no_rows_out(spark, pending_only):
    """Items are cut once; neither side of the reconciliation shuffles them to read them on enough tasks."""
    jobs = Jobs(spark, FOLDER).batch(pending_only=pending_only)
    for df in (jobs.recon_raw(), jobs.recon_logic()):
        assert not [line for line in _optimized(df) if "Repartition" in line and "l_orderkey" in line]


def test_exported_reconciliation_takes_a_batch(spark, monkeypatch):
    seen = []
    batch = Jobs.batch
    monkeypatch.setattr(Jobs, "batch", lambda self, **options: seen.append(options) or batch(self, **options))
    assert QUERIES["export_reconciliation"](spark, FOLDER).count() and seen == [{}]


def test_merchant_orders_are_added_up_without_their_spellings_where_none_is_shown(spark):
    jobs = Jobs(spark, FOLDER)
    sums = reconciliation._labelled(jobs.orders_fbm(), {"fbm_orders": F.col("principal")})
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "min(order_id" not in plan


@pytest.mark.parametrize("name, folder", [("export_raw_settlement", "raw"), ("export_sales_files", "sales")])
def test_files_of_a_round_trip_are_packed(spark, name, folder):
    def files():
        return {f for d in pathlib.Path(shared_dir(spark)).glob(f"{folder}-*") for f in d.rglob("part-*")}

    before = files()
    assert QUERIES[name](spark, FOLDER).columns
    new = files() - before
    assert new and all(f.name.endswith(".csv.gz") for f in new)


def test_raw_lines_are_dealt_out_without_their_reference(spark, monkeypatch):
    plans = []
    deal = sinks._by_partition
    monkeypatch.setattr(sinks, "_by_partition", lambda df, partitions: plans.append(df.columns) or deal(df, partitions))
    out = QUERIES["export_raw_settlement"](spark, FOLDER)
    assert "class_code" in out.columns and "class_code" not in plans[0]


def test_marking_lines_complete_shuffles_few_of_them(spark):
    """All lines that the maps of SKUs settle stay where they lie: the first branch meets nothing but broadcast maps."""
    plan = QUERIES["mark_complete"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    first = plan.split("\n:- ")[1].split("\n+- ")[0]
    assert "rightHint=(strategy=broadcast)" in first.splitlines()[1] + first.splitlines()[2] + first.splitlines()[3]
