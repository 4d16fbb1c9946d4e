"""Business rules on hand-made rows that the derived tables do not show."""

import datetime as dt
from decimal import Decimal
from functools import partial

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.sizing import marked_listed
from ledgerloom.operators import credits, drafts, inventory_events, ledger, products, reconciliation, sales, stock
from ledgerloom.operators.product_match import attach_products, canonical_inventory, resolve_products, with_known
from ledgerloom.params import ErpLayout
from ledgerloom.sources.feeds import INVENTORY_SCHEMA, PREPACK_SCHEMA, REFERENCE_SCHEMA, SETTLEMENT_SCHEMA

LAYOUT = ErpLayout(stores={"acct_0": 1})
POSTED = dt.datetime(2021, 3, 4, 12, 0)
START, END = dt.date(2021, 3, 1), dt.date(2021, 3, 14)


def line(kind="Order", category="ItemPrice", fee="Principal", amount="10.00", quantity=None, order="O1", sku="S1", settlement=1, currency="USD", posted=POSTED):
    return ("acct_0", settlement, currency, START, END, posted, order, sku, kind, category, fee, Decimal(amount), quantity, "POSTED")


def reference(*rows):
    """(type, category, fee, class) rows."""
    return [(i, t, c, f, "M", "S", "", k, k) for i, (t, c, f, k) in enumerate(rows, 1)]


@pytest.fixture(scope="module")
def make(spark):
    def settlements(*rows):
        return spark.createDataFrame(list(rows), SETTLEMENT_SCHEMA)

    def fees(*rows):
        return spark.createDataFrame(reference(*rows), REFERENCE_SCHEMA)

    def inventory(*rows):
        names = spark.createDataFrame([], INVENTORY_SCHEMA).columns
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], INVENTORY_SCHEMA)

    def prepack(*rows):
        names = spark.createDataFrame([], PREPACK_SCHEMA).columns
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], PREPACK_SCHEMA)

    def product_list(*rows):
        return spark.createDataFrame(list(rows), "account_name string, sku string, asin string, upc string, fulfillment_channel string")

    return {"settlements": settlements, "fees": fees, "inventory": inventory, "prepack": prepack, "products": product_list}


def test_fee_key_ignores_case_and_blank_equals_null(make):
    s = make["settlements"](line("Order", "ItemFees", "Commission"), line("Storage Fee", None, None, order=None, sku=None), line("Order", "Odd", "Odd"))
    out = {r["fee_type"]: r["credit_memo_class"] for r in ledger.fee_ledger(s, make["fees"](("order", "itemfees", "commission", "AMZF"), ("storage fee", "", "", "ST"))).collect()}
    assert out == {"Commission": "AMZF", None: "ST", "Odd": None}


def test_reference_fan_out_is_one_line_with_a_count(make):
    out = ledger.fee_ledger(make["settlements"](line()), make["fees"](("Order", "ItemPrice", "Principal", "A"), ("ORDER", "ItemPrice", "principal", "B"))).collect()
    assert len(out) == 1 and out[0]["line_count"] == 2 and out[0]["credit_memo_class"] == "A" and out[0]["id"] == 1


def test_duplicate_credits_stay_apart(make):
    fee = line("Order", "ItemFees", "Commission", "-1.00")
    ranked = ledger.duplicate_ranks(ledger.ledger_lines(make["settlements"](fee, fee)))
    assert sorted(r["ranking"] for r in credits.credit_rollup(ranked).collect()) == [1, 2]


def test_rank_counts_within_the_local_day(make):
    early, late = dt.datetime(2021, 3, 4, 2, 30), dt.datetime(2021, 3, 4, 12, 0)
    ranked = ledger.duplicate_ranks(ledger.ledger_lines(make["settlements"](line(posted=early), line(posted=late), line(posted=late.replace(hour=13)))))
    assert sorted((r["posted_date"].hour, r["ranking"]) for r in ranked.collect()) == [(2, 1), (12, 1), (13, 2)]


def test_units_count_every_principal_price_only_item_price(spark, make):
    s = make["settlements"](line(quantity=2, amount="9.00"), line("Order", "Promotion", "Principal", "-1.00", 2))
    listed = spark.createDataFrame([("O1", "S1", "Amazon"), ("O1", "S1", "Amazon")], "order_id string, sku string, fulfillment_channel string")
    row = sales.order_rollup_fba(ledger.ledger_lines(s), listed).collect()
    assert len(row) == 1 and row[0]["quantity"] == 4 and row[0]["principal"] == 9 and row[0]["total_amount"] == 8


def test_order_without_quantity_has_no_price_and_one_group(spark, make):
    s = make["settlements"](line("Liquidations", "ItemPrice", "Tax", "1.00"), line("Liquidations", "ItemPrice", "Tax", "2.00", order="O2"))
    listed = spark.createDataFrame([("O1", "S1", "Amazon"), ("o2", "s1", "AMAZON")], "order_id string, sku string, fulfillment_channel string")
    orders = sales.order_rollup_fba(ledger.ledger_lines(s), listed)
    resolved = resolve_products(s.select("sku").distinct(), make["products"](), make["inventory"](), "orders")
    out = sales.sales_extract(orders, resolved, layout=LAYOUT).collect()
    assert len(out) == 1 and out[0]["customer_price"] is None and out[0]["units"] is None and out[0]["tax"] == 3 and out[0]["style"] == "S1"


def test_foreign_price_is_rounded_once_and_needs_a_rate(spark, make):
    s = make["settlements"](line(quantity=3, amount="100.00", settlement=5, currency="MXN"), line(quantity=3, amount="100.00", settlement=6, currency="MXN"))
    listed = spark.createDataFrame([("O1", "S1", "Amazon")], "order_id string, sku string, fulfillment_channel string")
    fx = spark.createDataFrame([(5, Decimal("17.83794208"))], "settlement_id bigint, exchange_value decimal(20,10)")
    resolved = resolve_products(s.select("sku").distinct(), make["products"](), make["inventory"](), "orders")
    out = {r["settlement_id"]: r for r in sales.sales_extract(sales.order_rollup_fba(ledger.ledger_lines(s), listed), resolved, fx, layout=LAYOUT).collect()}
    assert out[5]["customer_price_1"] == Decimal("1.8687") and out[5]["customer_price"] == Decimal("1.87") and out[6]["customer_price"] is None


def test_order_line_without_fee_type_is_no_credit(make):
    s = make["settlements"](line("Order", "ItemPrice", None), line("Order", None, "Shipping"), line("Refund", None, None))
    kept = ledger.ledger_lines(s).where(credits.is_credit()).collect()
    # A known fee that is neither principal nor tax is a credit; with the category unknown it still is none of both.
    assert sorted((r["transaction_type"], r["fee_type"] or "") for r in kept) == [("Order", "Shipping"), ("Refund", "")]


def test_unmapped_fee_leaves_credits_and_shows_in_reconciliation(spark, make):
    s = make["settlements"](line("Odd Fee", None, None, "-3.00", order=None, sku=None), line("Known", None, None, "-2.00", order=None, sku=None))
    fees = make["fees"](("known", None, "", "K"))
    lines = ledger.ledger_lines(s)
    resolved = resolve_products(s.select("sku").distinct(), make["products"](), make["inventory"](), "orders")
    out = credits.credit_extract(lines, fees, resolved, layout=LAYOUT).collect()
    assert [(r["misc_description"], r["amount"], r["division"], r["style"]) for r in out] == [("Known", Decimal("2.00"), 31, "000-AMZ")]
    none = spark.createDataFrame([], "order_id string, sku string, fulfillment_channel string")
    raw = reconciliation.recon_raw(lines, none, fees).first()
    assert raw["unmapped"] == -3 and raw["credits_usd"] == -2 and raw["total_amount"] == -5


def test_two_channels_double_the_raw_side(spark, make):
    listed = spark.createDataFrame([("O1", "S1", "Amazon"), ("O1", "S1", "Merchant")], "order_id string, sku string, fulfillment_channel string")
    raw = reconciliation.recon_raw(ledger.ledger_lines(make["settlements"](line())), listed, make["fees"]()).first()
    assert raw["total_amount"] == 20 and raw["fba_orders_usd"] == 10 and raw["fbm_orders_usd"] == 10


def test_match_takes_each_column_from_the_first_rung_that_has_it(make):
    inventory = make["inventory"](
        {"warehouse": 1, "upc": "111", "asin": "B01", "style": "E-style"},
        {"warehouse": 1, "upc": "222", "asin": None, "style": "F-style", "division": 7},
    )
    listed = make["products"](("acct_0", "S1", "B01", "222", "AMAZON_NA"))
    skus = make["settlements"](line()).select("sku")
    row = resolve_products(skus, listed, inventory, "orders").first()
    assert (row["erp_upc"], row["rung"], row["style"], row["division"]) == ("111", "E", "E-style", 7)
    two = resolve_products(skus, listed, inventory, "two_rung").first()
    assert (two["erp_upc"], two["style"], two["division"]) == ("222", "F-style", 7)


def test_match_rungs_against_brute_force(make):
    inventory = [{"warehouse": 1, "upc": str(100 + i), "asin": f"B{i % 4}" if i % 2 else None, "style": f"st{i}" if i % 3 else None, "division": i if i % 5 else None} for i in range(12)]
    listed = [("acct_0", f"S{i}-{100 + i}" if i % 2 else f"S-0{100 + i}", f"B{i % 5}" if i % 4 else None, ["", "1", None, f"B{i % 4}", str(100 + i), f"0{100 + i}"][i % 6], "AMAZON_NA") for i in range(24)]
    listed += [("acct_1", listed[3][1], "B1", "105", "AMAZON_NA"), ("acct_1", listed[4][1], "B3", "0107", "AMAZON_NA")]
    skus = sorted({p[1] for p in listed} | {"none", "x103"})
    pairs = {(p[2], p[3]) for p in listed if p[2] and p[3] is not None and not p[3].lower().startswith("b")}
    expected = {}
    for sku in skus:
        keys = []
        for _, _, asin, upc, _ in [p for p in listed if p[1] == sku]:
            mine = [(a, u) for a, u in pairs if a == asin]
            for a, u in mine:
                keys += [("E", "asin", a), ("F", "upc", u), ("G", "upc", u[1:])]
            keys.append(("H", "asin", (asin if mine else None) if upc == "" else upc))
        digits = "".join(c if c.isdigit() else " " for c in sku).split()
        if digits:
            keys += [("I", "upc", digits[0]), ("J", "upc", digits[0][1:])]
        found = sorted((rung, row["upc"], i) for rung, kind, key in keys for i, row in enumerate(inventory) if key is not None and row[kind] == key)
        first = lambda c: next((inventory[i][c] for _, _, i in found if inventory[i][c] is not None), None)
        expected[sku] = (found[0][0] if found else None, first("upc"), first("style"), first("division"))
    frame = make["settlements"](*[line(sku=s) for s in skus]).select("sku")
    got = resolve_products(frame, make["products"](*listed), make["inventory"](*inventory), "orders").collect()
    assert {r["sku"]: (r["rung"], r["erp_upc"], r["style"], r["division"]) for r in got} == expected


def test_lines_without_sku_keep_null_attributes(make):
    inventory = make["inventory"]({"warehouse": 1, "upc": "111", "asin": "B01", "style": "x"})
    resolved = resolve_products(make["settlements"](line()).select("sku"), make["products"](("acct_0", "s1", "B01", "111", None)), inventory, "orders")
    lines = ledger.ledger_lines(make["settlements"](line(), line(sku=None), line(sku="")))
    got = attach_products(lines, resolved, ["erp_upc"]).collect()
    assert sorted((r["sku"], r["erp_upc"] or "") for r in got) == [("", ""), ("", ""), ("S1", "111")]


def test_canonical_inventory(make):
    rows = [{"upc": u, "warehouse": w} for u, w in (("0", 1), ("00", 1), ("B0AB", 1), ("12", 2), ("12", 1), (None, 1))]
    assert [(r["upc"], r["warehouse"]) for r in canonical_inventory(make["inventory"](*rows)).collect()] == [("12", 1)]


def test_missing_report_gives_a_second_chance_to_blank_upcs(make):
    inventory = make["inventory"]({"warehouse": 1, "upc": "S9"}, {"warehouse": 1, "upc": "5"})
    skus = make["settlements"](line(sku="GONE"), line(sku="S5")).select("account_name", "sku")
    out = products.missing_upc_report(skus, make["products"](), inventory).collect()
    assert [r["sku"] for r in out] == ["GONE"]


def test_prepack_slots_and_allocation(make):
    base = {"division": 1, "warehouse": 1, "season": "S21", "style": "st", "color": "red", "pack_dim": "PP", "size": "PPK", "upc": "55", "avail_in_stock": 10, "wip": None, "in_transit": None}
    pack = {"division": 1, "prepack_code": "pp", "season": "s", "total_units": 3, **{f"size_{i}": f"Z{i}" for i in range(1, 31)}, **{f"qty_{i}": 1 for i in range(1, 31)}}
    inventory, prepack = make["inventory"](base), make["prepack"](pack)
    joined = stock.prepack_join(inventory, prepack)
    assert stock.prepack_size_explode(joined).count() == 30 and stock.prepack_size_explode(joined, 29).count() == 29
    out = stock.final_stock(inventory, prepack).collect()
    assert len(out) == 30 and {(r["units_per_size"], r["wip_per_size"], r["in_transit_per_size"], r["upc"]) for r in out} == {(3, None, 0, "0")}
    whole = stock.final_stock(inventory, make["prepack"]({**pack, "total_units": 0})).first()
    assert whole["units_per_size"] == 10


def test_backfill_takes_the_smallest_upc(make):
    packed = {"division": 1, "warehouse": 1, "season": "S21", "style": "st", "color": "red", "pack_dim": "PP", "size": "ppk", "upc": "9"}
    loose = {**packed, "pack_dim": "M", "size": "Z1"}
    inventory = make["inventory"](packed, {**loose, "upc": "31"}, {**loose, "upc": "30", "warehouse": 2}, {**loose, "upc": "0", "warehouse": 3})
    prepack = make["prepack"]({"division": 1, "prepack_code": "PP", "season": "S", "total_units": 2, "size_1": "z1", "qty_1": 2, "size_2": "Z2", "qty_2": 0})
    out = stock.final_stock(inventory, prepack).collect()
    assert sorted((r["warehouse"], r["type"], r["upc"]) for r in out) == [(1, "NO SIZE", "31"), (1, "SIZE_1", "30"), (2, "NO SIZE", "30"), (3, "NO SIZE", "30")]


def test_warehouses_without_override_are_all_kept(make):
    inventory = make["inventory"]({"warehouse": 1}, {"warehouse": 2})
    assert sorted(tuple(r) for r in stock.warehouse_list(inventory).collect()) == [(1, "", ""), (2, "", "")]


def test_new_fee_keys_continue_the_ids(make):
    s = make["settlements"](line("Zeta", None, ""), line("alpha", "C", "F"), line("ALPHA", "c", "f"), line("known", None, None))
    out = ledger.fee_reference_refresh(s, make["fees"](("Known", "", None, "K"))).collect()
    assert sorted((r["id"], r["transaction_type"].lower()) for r in out) == [(1, "known"), (2, "alpha"), (3, "zeta")]


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    assert sorted((r["k"], r["key_count"]) for r in ledger.check_unique_keys(df, ["k", "v"]).collect()) == [(1, 2), (2, 1)]


def test_replacing_by_key_twice_changes_nothing(spark):
    current = spark.createDataFrame([("RAW", 1, 5), ("LOGIC", 1, 6), ("LOGIC", 2, 7)], "type string, settlement_id int, v int")
    changes = spark.createDataFrame([("LOGIC", 1, 60), ("LOGIC", 3, 8)], current.schema)
    once = reconciliation.replace_by_key(current, changes, ["type", "settlement_id"])
    twice = reconciliation.replace_by_key(once, changes, ["type", "settlement_id"])
    want = [("LOGIC", 1, 60), ("LOGIC", 2, 7), ("LOGIC", 3, 8), ("RAW", 1, 5)]
    assert sorted(map(tuple, once.collect())) == want and sorted(map(tuple, twice.collect())) == want


def test_credit_without_color_is_not_connected(spark):
    df = spark.createDataFrame([("s", None), ("s", "c"), ("", None), (None, None)], "style string, color string")
    assert [r["connected"] for r in credits.credit_connected_split(df).collect()] == [False, True, True, True]


def test_equal_events_share_one_adjustment(spark, make):
    schema = "company_name string, event_date date, transaction_type string, fnsku string, sku string, fulfillment_center_id string, quantity int, disposition string"
    event = ("acct_0", START, "Adjustments", "B01", "S1", "FC", 2, "SELLABLE")
    events = spark.createDataFrame([event, event, ("acct_0", START, "Shipments", "B01", "S1", "FC", 2, "SELLABLE")], schema)
    log = inventory_events.inventory_event_ledger(events, F.lit(START), F.lit(END))
    assert sorted(r["ranking"] for r in log.collect()) == [1, 2]
    inventory = make["inventory"]({"warehouse": 1, "upc": "111", "asin": "B01", "style": "x", "division": 4, "season": "S21"})
    resolved = resolve_products(events.select("sku"), make["products"](), inventory, "inventory", events)
    out = inventory_events.inventory_adjustment_extract(inventory_events.inventory_adjustment_conversion(log, resolved)).collect()
    assert [(r["units"], r["division"], r["season_year"], r["connected"]) for r in out] == [(2, 4, "21", True)]


def test_status_marking(spark, make):
    rows = [("c", 1, POSTED, "Order", "PRICE_TYPE", "Principal", "S1"), ("c", 1, POSTED, "Order", "PRICE_TYPE", "Principal", "S2"),
            ("c", 1, POSTED, "Storage Fee", "", "", ""), ("c", 1, POSTED, "Refund", "PRICE_TYPE", "Tax", ""), ("c", 1, POSTED, "Fee", "x", "y", "S2")]
    lines = spark.createDataFrame(rows, "company_name string, settlement_id int, posted_date timestamp_ntz, transaction_type string, fee_category string, fee_type string, sku string")
    resolved = resolve_products(lines.select("sku"), make["products"](("c", "S1", "B01", "111", "AMAZON_NA"), ("c", "S2", "B02", "111", "DEFAULT")),
                                make["inventory"]({"warehouse": 1, "upc": "111"}), "two_rung")
    out = drafts.mark_complete(lines.withColumn("status", F.lit("Not Imported")), resolved).collect()
    assert sorted((r["transaction_type"], r["sku"], r["status"]) for r in out) == [
        ("Fee", "S2", "Not Imported"), ("Order", "S1", "Complete"), ("Order", "S2", "Not Imported"), ("Refund", "", "Not Imported"), ("Storage Fee", "", "Complete")]


def test_known_skus_are_those_the_list_has_a_product_for(spark, monkeypatch):
    """By maps of hashes and, where both let a SKU pass, by the list; maps of 64 bits let nearly all pass."""
    facts = spark.range(600).selectExpr("id", "case id % 20 when 0 then null when 1 then '' when 2 then concat('š', id) else concat('S', id % 250) end as sku")
    resolved = spark.range(250).selectExpr("concat('s', id) as sku_key", "case when id % 3 > 0 then cast(id as string) end as erp_upc")
    wanted = {r["id"]: r["erp_upc"] is not None for r in attach_products(facts, resolved, ["erp_upc"]).collect()}
    for bits in (64, 1 << 26):
        with monkeypatch.context() as m:
            m.setattr("ledgerloom.operators.product_match.marked_listed", partial(marked_listed, bits=bits))
            told = with_known(facts, resolved, "known")
        assert told.columns == ["id", "sku", "known"] and {r["id"]: r["known"] for r in told.collect()} == wanted and told.count() == 600
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("Union")


def test_an_order_counts_once_per_channel_also_under_none(spark):
    rows = [("c", 1, POSTED, "Order", "PRICE_TYPE", "Principal", o, "S", Decimal("0.10"), 2, "Not Imported") for o in ("o1", "O1", "o2", "o3")]
    lines = spark.createDataFrame(rows, "company_name string, settlement_id int, posted_date timestamp_ntz, transaction_type string, fee_category string, fee_type string, "
                                        "order_id string, sku string, amount decimal(12,2), quantity_purchased int, status string")
    orders = spark.createDataFrame([("O1", "s", "Amazon"), ("o1", "S", "Amazon"), ("o1", "S", None), ("o1", "S", None), ("o1", "S", "Merchant"), ("o2", "S", None)],
                                   "order_id string, sku string, fulfillment_channel string")
    out = drafts.order_buckets(lines, orders)
    assert {r["order_id"].lower(): (r["fulfillment_channel"], r["quantity"], r["principal"]) for r in out.collect()} == {
        "o1": ("Amazon", 12, Decimal("0.60")), "o2": (None, 2, Decimal("0.10")), "o3": (None, 2, Decimal("0.10"))}
    aggregates = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in x]
    assert len(aggregates) == 2


def test_spellings_of_one_order_share_a_unit_price(spark, make):
    s = make["settlements"](line(quantity=1, amount="10.00", sku="AB"), line(quantity=1, amount="20.00", order="o1", sku="ab"))
    listed = spark.createDataFrame([("O1", "Ab", "Amazon")], "order_id string, sku string, fulfillment_channel string")
    orders = sales.order_rollup_fba(ledger.ledger_lines(s), listed)
    assert [(r["order_id"], r["sku"], r["quantity"], r["principal"]) for r in orders.collect()] == [("O1", "AB", 2, 30)]
    resolved = resolve_products(s.select("sku").distinct(), make["products"](), make["inventory"](), "orders")
    out = sales.sales_extract(orders, resolved, layout=LAYOUT).collect()
    assert [(r["units"], r["customer_price"], r["style"]) for r in out] == [(2, Decimal("15.00"), "AB")]


def test_class_and_sub_class_come_from_one_row(spark):
    rows = [(1, "Fee", "", "", "M", "S", "", "A", "Z"), (2, "fee", None, "", "M", "S", "", "B", "Y"), (3, "Fee", None, None, "M", "S", "", None, "X")]
    row = ledger.fee_classes(spark.createDataFrame(rows, REFERENCE_SCHEMA)).collect()
    assert [(r["credit_memo_class"], r["credit_memo_sub_class"], r["line_count"]) for r in row] == [("A", "Z", 3)]


def test_repeated_rates_and_prepacks_fail_with_their_key(spark, make):
    s = make["settlements"](line(quantity=1, settlement=5, currency="MXN"), line(quantity=1, settlement=6))
    listed = spark.createDataFrame([("O1", "S1", "Amazon")], "order_id string, sku string, fulfillment_channel string")
    orders = sales.order_rollup_fba(ledger.ledger_lines(s), listed)
    fx = spark.createDataFrame([(5, Decimal("17.5")), (5, Decimal("18"))], "settlement_id bigint, exchange_value decimal(20,10)")
    with pytest.raises(Exception, match="settlement_id = 5"):
        sales.unit_prices(orders, fx).collect()
    pack = {"division": 1, "prepack_code": "PP", "season": "S", "total_units": 3}
    stocked = make["inventory"]({"division": 1, "warehouse": 1, "season": "S21", "pack_dim": "PP"})
    with pytest.raises(Exception, match="prepacks: more than one row"):
        stock.prepack_join(stocked, make["prepack"](pack, {**pack, "prepack_code": "pp"})).collect()


def test_layout_has_to_name_the_stores(spark, make):
    with pytest.raises(ValueError, match="stores"):
        sales.store_number(ErpLayout())
