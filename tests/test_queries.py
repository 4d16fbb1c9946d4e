"""Registered queries against their SQL, and results that must not depend on the partitioning."""

import os
import pathlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, plain
from ledgerloom.plans.oracle import oracle_queries
from ledgerloom.plans.registry import QUERIES, flagship

FOLDER = os.environ.get("LEDGERLOOM_TESTDATA", "/root/testdata/sf0.001")
# A cross-section; check_oracle.py runs all of them.
CHECKED = ["fee_ledger", "settlement_line_id", "missing_upc_report", "order_rollup_fba", "sales_extract_mxn", "credit_rollup", "credit_extract_usd", "credit_extract_mxn",
           "recon_raw", "recon_logic", "reconcile_pending", "reconciliation_shrinks", "check_keyed_inputs", "pending_settlements", "fee_reference_refresh",
           "prepack_join", "sellable_stock", "inventory_adjustment_extract", "order_buckets", "refund_extract", "zone_comparison", "mark_orders_by_status_rungs",
           "sku_match_list_since", "recent_order_principals", "settlement_day_lookup", "profile_column_types", "profile_number_texts", "src_inventory_feed", "src_statements_in_blocks",
           "src_fx_rates", "feed_rejects", "feed_fault_counts", "feed_rejected_rows", "feed_sound_rows", "pending_from_files", "exported_from_files", "inventory_event_rank", "mark_events_complete", "union_store_codes", "ingest_new_files", "export_inventory_adjustments"]

pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for table in TABLES:
        if pathlib.Path(f"{FOLDER}/{table}.parquet").exists():
            db.execute(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    return db


def test_every_query_is_named_and_checked():
    assert set(oracle_queries()) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    theirs = Counter(tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in cursor.fetchall())
    ours = Counter(tuple(plain(r[c]) for c in sorted(columns)) for r in frame.collect())
    assert ours == theirs


def test_every_amount_is_mapped_excluded_or_unmapped(spark):
    report = flagship(spark, FOLDER).where("type = 'Raw Settlement Data'").collect()
    assert report and all(r["total_amount"] is not None for r in report)


def test_result_does_not_depend_on_partitions(spark):
    results = []
    for n in ("2", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(Counter(map(str, entry.queries()["fee_ledger"](spark, FOLDER).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]
