"""DuckDB SQL of every query with a declarative answer, written independently of the jobs.

``STEPS`` are common table expressions over the derived tables, ``FINAL`` the queries. Each text gets
the expressions it names, directly or through others, as its WITH clause.
"""

from __future__ import annotations

import re

from ledgerloom.params import PREPACK_SLOTS, STOCK_ATTRIBUTES
from ledgerloom.plans.dataset import AS_OF, FIXTURE_LAYOUT as LAYOUT, SETTLEMENT_COLUMNS
from ledgerloom.plans.oracle_views import VIEWS

ATTRIBUTES = ["erp_upc", *STOCK_ATTRIBUTES]
LOCAL_DAY = "cast((posted_date at time zone 'US/Eastern') at time zone 'US/Pacific' as date)"
NUMERIC_UPC = r"regexp_matches(upc, '^\s*[+-]?0*\.?0*[1-9]')"
DIGITS = "nullif(regexp_extract(s.sku, '[0-9]+'), '')"
LINE = "account_name, settlement_id, currency, start_date, end_date, posted_date, order_id, sku, transaction_type, fee_category, fee_type, amount, quantity_purchased"
ORDER_TYPES = "('Order', 'TBYB Order Payment')"
RESERVES = "('Payable to Amazon', 'Current Reserve Amount', 'Previous Reserve Amount Balance')"
LIQUIDATIONS = "('Liquidations', 'Liquidations Adjustments')"


def money(text: str) -> str:
    return f"cast({text} as decimal(34,2))"


def half_up(number: str, divisor: str, scale: int) -> str:
    """Exact quotient of money by an integer in 1e-10 units, half away from zero."""
    n, d = f"cast({number} * 100 as hugeint)", f"({divisor})"
    units = f"(case when {n} < 0 then -1 else 1 end) * ((abs({n}) * {2 * 10 ** (8 + scale)} + {d}) // (2 * {d}))"
    return f"case when {d} <> 0 then cast({units} as decimal(24,0)) * cast({10 ** -scale:.{scale}f} as decimal({scale + 1},{scale})) end"


RATE_ONE = "cast(10000000000 as hugeint)"
RATE_FX = "cast(fx.exchange_value * 10000000000 as hugeint)"


def resolved(skus: str, variant: str, by_account: bool = False) -> str:
    """One row per SKU: every rung joined on its own, then the first value per column."""
    match = "lower(b.sku) = lower(s.sku)" + (" and b.account_name = s.account_name" if by_account else "")
    pairs = {"two_rung": "pairs_marketplace", "status": "pairs_all"}.get(variant, "pairs")
    b = f"from s join product_data b on {match}"
    c = f"{b} join {pairs} c on c.asin = b.asin"
    cl = f"{b} left join {pairs} c on c.asin = b.asin"
    tail = "i.upc = substring(c.upc, 2)"
    listing = "i.asin = case when b.upc = '' then c.asin else b.upc end"
    digits = {"I": f"from s join canon i on i.upc = {DIGITS}", "J": f"from s join canon i on i.upc = substring({DIGITS}, 2)"}
    rungs = {
        "orders": {"E": f"{c} join canon i on i.asin = c.asin", "F": f"{c} join canon i on i.upc = c.upc", "G": f"{c} join canon i on {tail}",
                   "H": f"{cl} join canon i on {listing}", **digits},
        "report": {"E": f"{b} join canon i on i.upc = b.upc", "F": f"{c} join canon i on i.asin = c.asin", "G": f"{c} join canon i on {tail}",
                   "H": f"{cl} join canon i on {listing}", **digits},
        "inventory": {"E": f"{c} join canon i on i.upc = c.upc",
                      "F": f"from s left join product_data b on {match} left join {pairs} c on c.asin = b.asin "
                           "left join (select distinct sku, fnsku from inventory_events) d on lower(d.sku) = lower(s.sku) join canon i on i.asin = coalesce(c.asin, d.fnsku)",
                      "G": f"{c} join canon i on {tail}", "H": f"{cl} join canon i on {listing}", **digits},
        "two_rung": {"E": f"{c} join canon i on i.upc = c.upc", "F": f"{c} join canon i on {tail}"},
        "status": {"E": f"{c} join canon i on i.upc = c.upc", "F": f"{c} join canon i on {tail}", "G": f"{b} join canon i on i.asin = b.asin"},
    }
    found = " union all ".join(f"select s.sku, '{r}' as rung, i.* {frm}" for r, frm in rungs[variant].items())
    best = ", ".join(f"arg_min({a}, rung || upc) filter (where {a} is not null) as {a}" for a in ATTRIBUTES)
    return f"""with s as ({skus}), found as (select *, upc as erp_upc from ({found}) u),
        best as (select sku, arg_min(rung, rung || upc) as rung, {best} from found group by sku),
        about as (select s.sku, min(b.upc) as product_id, min(b.asin) as product_asin, min(c.asin) as listed_asin, min(c.upc) as listed_upc
          from s left join product_data b on {match} left join {pairs} c on c.asin = b.asin group by s.sku)
        select a.*, best.* exclude (sku) from about a left join best on best.sku = a.sku"""


def stock_join(facts: str, products: str, columns: list[str]) -> str:
    return f"select f.*, {', '.join(f'r.{c}' for c in columns)} from {facts} f left join {products} r on lower(r.sku) = lower(f.sku)"


def store() -> str:
    return "case account_name " + " ".join(f"when '{a}' then {n}" for a, n in LAYOUT.stores.items()) + " end"


def codes(mapping: dict[str, str]) -> str:
    return "case currency " + " ".join(f"when '{c}' then '{v}'" for c, v in mapping.items()) + " end"


def blanks(first: int, last: int) -> str:
    return ", ".join(f"'' as blank_{i}" for i in range(first, last + 1))


NUMBER = "cast(settlement_id as varchar) || '_' || coalesce(cast(division as varchar), '') || '_' || coalesce(cast(sub_div as varchar), '')"
END = "strftime(end_date, '%m/%d/%Y')"
SALES = f"""select account_name, settlement_id, currency, '1' as company, division, {codes(LAYOUT.sales_customer)} as customer_number,
    {store()} as store_number, {NUMBER} as external_order_number, {END} as order_date, {END} as start_date, {END} as cancel_date, 82 as terms,
    'RTG' as routing, 297 as warehouse, 'JDE' as sales_rep, {NUMBER} as customer_po_number, {blanks(1, 6)}, 0 as merch_discount, 'S' as order_type,
    left(min(season), 1) as style_season, right(min(season), 2) as style_year, min(style) as style, '' as sku200, min(color) as sku300, min(pack_dim) as sku400, min(size) as size_code,
    cast(sum(quantity) as bigint) as units, price_2 as customer_price, price_2 as cop_price, min(price_4) as customer_price_1, min(price_4) as cop_price_1,
    0 as dollar_discount, {blanks(7, 14)}, 0 as misc, 0 as freight, {money('sum(tax)')} as tax, {blanks(15, 17)}, 'A' as order_origin
    from priced group by account_name, settlement_id, currency, end_date, division, sub_div, lower(style), lower(color), lower(pack_dim), lower(size), price_2"""

CREDIT_FILTER = f"""not (transaction_type in {ORDER_TYPES} and ((fee_category = 'ItemPrice' and fee_type = 'Principal') or fee_type ilike '%tax%'))"""
CREDITS = f"""select account_name, settlement_id, currency, '1' as company, division, '' as invoice_number, strftime(end_date, '%m/%d/%y') as invoice_date,
    'S/00' as season, {codes(LAYOUT.credit_customer)} as customer_number, {store()} as store_number, '' as order_type,
    cast(settlement_id as varchar) || '_' || cast(division as varchar) as customer_po_number, 297 as warehouse, sub_division, '' as factor_code, 'C' as sales_rea,
    'JDE' as sales_rep, 82 as terms_code, {money(f"case when currency = 'MXN' then {half_up('-total', RATE_FX, 2)} else -total end")} as amount,
    transaction_type as misc_description, class_code as credit_memo_class, subclass_code as credit_memo_sub_class, '66' as business_unit, '' as y_tax,
    '' as tax_amount, 'JDE' as sales_manager, sub_division || '-AMZ' as style, '' as fabric, 'ASST' as color
    from (select a.account_name, a.settlement_id, a.currency, a.end_date, coalesce(r.division, 31) as division,
      coalesce(cast(r.sub_div as varchar), '000') as sub_division, c.class_code, c.subclass_code, a.transaction_type, sum(a.amount) as total
      from (select * from lines where {CREDIT_FILTER}) a left join classes c on {{on}} left join r_orders r on lower(r.sku) = lower(a.sku)
      where c.class_code <> 'X' group by all) g left join fx_rates fx using (settlement_id)"""

# The faults written into the stock feed, in the order of its columns.
FAULTY_STOCK = """select *, concat_ws(',', case when carton_qty % 14 = 0 then 'carton_qty' end, case when carton_qty % 22 = 0 then 'cost' end,
    case when avail_in_stock % 156 = 0 or avail_in_stock % 204 = 0 then '_broken_record' end) as faults from inventory"""
CLASS_ON = " and ".join(f"coalesce(lower(a.{k}), '') = c.{k}" for k in ("transaction_type", "fee_category", "fee_type"))
CREDITS = CREDITS.replace("{on}", CLASS_ON)


def rollup(types: str, channel: str) -> str:
    return f"""select a.account_name, a.settlement_id, a.currency, a.start_date, a.end_date, min(a.order_id) as order_id, min(a.sku) as sku, min(posted_date) as posted_date,
        cast(sum(case when fee_type = 'Principal' then quantity_purchased end) as bigint) as quantity, sum(amount) as total_amount,
        sum(case when fee_type = 'Principal' and (fee_category = 'ItemPrice' or (transaction_type in {LIQUIDATIONS} and fee_category = 'PRICE_TYPE')) then amount else 0 end) as principal,
        sum(case when fee_type ilike '%tax%' then amount else 0 end) as tax, '{channel}' as fulfillment_channel
        from lines a join (select distinct lower(order_id) as order_key, lower(sku) as sku_key from all_orders where fulfillment_channel = '{channel}') b
          on b.order_key = lower(a.order_id) and b.sku_key = lower(a.sku)
        where transaction_type in {types} group by 1, 2, 3, 4, 5, lower(a.order_id), lower(a.sku)"""


BUCKETS = [f"{p}_{m}_{u}" for p in ("fba", "fbm") for m in ("orders", "tax") for u in ("usd", "cad", "mxn")] + ["credits_usd", "credits_cad", "credits_mxn"]


def _raw_bucket(name: str) -> str:
    kind, _, rest = name.partition("_")
    unit = name[-3:].upper()
    if kind == "credits":
        condition = f"transaction_type not in {RESERVES} and class_code <> 'X' and {CREDIT_FILTER}"
    else:
        measure = "fee_category = 'ItemPrice' and fee_type = 'Principal'" if rest.startswith("orders") else "fee_type ilike '%tax%'"
        channel = "Amazon" if kind == "fba" else "Merchant"
        condition = f"transaction_type in {ORDER_TYPES} and {measure} and fulfillment_channel = '{channel}'"
    return f"{money(f'''sum(case when {condition} and currency = '{unit}' then amount else 0 end)''')} as {name}"


RECON_RAW = f"""select account_name, 'Raw Settlement Data' as type, settlement_id, min(start_date) as start_date, max(end_date) as end_date,
    {money('sum(amount)')} as total_amount, {', '.join(_raw_bucket(b) for b in BUCKETS)},
    {money(f"sum(case when transaction_type in {RESERVES} or class_code = 'X' then amount else 0 end)")} as exclusions,
    {money('sum(case when class_code is null then amount else 0 end)')} as unmapped
    from (select a.*, c.class_code, o.fulfillment_channel from lines a left join classes c on {CLASS_ON}
      left join (select distinct order_id, sku, fulfillment_channel from all_orders) o on lower(o.order_id) = lower(a.order_id) and lower(o.sku) = lower(a.sku)) t
    group by account_name, settlement_id"""

RECON_LOGIC = f"""select p.account_name, 'LOGIC' as type, p.settlement_id, p.start_date, p.end_date, {money('sum(amount)')} as total_amount,
    {', '.join(money(f"coalesce(sum(case when bucket = '{b}' then amount else 0 end), 0)") + f' as {b}' for b in BUCKETS)},
    {money('0')} as exclusions, {money('0')} as unmapped from period p left join (
      select account_name, settlement_id, 'fba_orders_' || lower(currency) as bucket, {money('sum(customer_price_1 * units)')} as amount from sales_all group by 1, 2, 3
      union all select account_name, settlement_id, 'fba_tax_' || lower(currency), sum(tax) from sales_all group by 1, 2, 3
      union all select account_name, settlement_id, 'fbm_orders_' || lower(currency), sum(principal) from fbm group by 1, 2, 3
      union all select account_name, settlement_id, 'fbm_tax_' || lower(currency), sum(tax) from fbm group by 1, 2, 3
      union all select account_name, settlement_id, 'credits_' || lower(currency), -sum(amount) from credits_all group by 1, 2, 3) l
      on l.account_name = p.account_name and l.settlement_id = p.settlement_id
    group by p.account_name, p.settlement_id, p.start_date, p.end_date"""

STOCK = ("division, div_name, sub_div, sub_div_desc, warehouse, warehouse_name, season, style, coalesce(color, '') as color, pack_dim, "
         "coalesce(size, '') as size, upc, carton_qty, avail_in_stock, in_transit, wip, cost, coalesce(sku200, '') as sku200")
STOCK_NAMES = re.sub(r"coalesce\((\w+), ''\) as \w+", r"\1", STOCK)
PACK = "size_scale_1, size_scale_2, size_scale_3, prepack_desc, total_units"
LOOSE = "('M', '*N', 'W')"
EXPLODED = " union all ".join(
    f"select {STOCK_NAMES}, {PACK}, 'SIZE_{i}' as type, size_{i} as size_detail, qty_{i} as qty from prepacked where total_units is not null"
    for i in range(1, PREPACK_SLOTS + 1))
LOOSE_ROWS = f"select {STOCK_NAMES}, {PACK}, 'NO SIZE' as type, size as size_detail, 1 as qty from prepacked where total_units is null and pack_dim in {LOOSE}"


def allocated(stock: str, fallback: str) -> str:
    n, d = f"(cast({stock} as bigint) * qty)", "total_units"
    return f"cast(coalesce(case when {d} <> 0 then (2 * {n} + {d}) // (2 * {d}) end, {fallback}) as int)"


EVENT = "company_name, event_date, transaction_type, fnsku, sku, fulfillment_center_id, quantity, disposition"
# Events are compared by folded texts; the derived events vary the spelling of SKU and centre.
EVENT_KEY = "company_name, event_date, transaction_type, fnsku, lower(sku), lower(fulfillment_center_id), quantity, disposition"
EVENT_RANK = f"row_number() over (partition by {EVENT_KEY} order by {EVENT}) as ranking"
DISTINCT_EVENT = ("select company_name, event_date, transaction_type, fnsku, min(sku) as sku, min(fulfillment_center_id) as fulfillment_center_id, quantity, disposition "
                  f"from {{ledger}} group by {EVENT_KEY}")
EVENT_WINDOW = "event_date between date '2024-01-03' and date '2024-01-29'"
DRAFT_LINE = "company_name, posted_date, posted_date_1, order_id, sku, transaction_type, fee_category, fee_type, amount, quantity_purchased"
DRAFT_RANK = ("row_number() over (partition by company_name, posted_date_1, lower(order_id), lower(sku), transaction_type, fee_category, fee_type, amount, quantity_purchased "
              "order by posted_date, order_id, sku)")
REFUND = "(transaction_type = 'Refund' and fee_category = 'PRICE_TYPE' and (fee_type = 'Principal' or fee_type ilike '%tax%'))"
FREIGHT = "(fee_category = 'ITEM_RELATED_FEE_TYPE' and fee_type in ('FBAPerUnitFulfillmentFee', 'FBAPerOrderFulfillmentFee', 'FBAWeightBasedFee'))"
PRICE = "(fee_category = 'PRICE_TYPE' and fee_type = 'Principal')"
AS_OF_DAY = f"date '{AS_OF}'"
MERGED = [a for a in STOCK_ATTRIBUTES if a != "size_scale"]


def draft_order_extract(source: str, number: str) -> str:
    return f"""select '01' as company, division, 'EASF02' as customer_number, 1 as store_number, {number} as external_order_number,
        posted_date as order_date, posted_date as start_date, posted_date as cancel_date, 82 as terms, 'RTG' as routing, 297 as warehouse, 'RBM' as sales_rep,
        {number} as customer_po_number, {blanks(1, 6)}, 0 as merch_discount, 'S' as order_type, left(season, 1) as style_season, right(season, 2) as style_year,
        style, sku200, color as sku300, pack_dim as sku400, size as size_code, quantity as units, principal as customer_price, principal as cop_price,
        0 as dollar_discount, {blanks(7, 14)}, misc, freight, tax, {blanks(15, 17)}, 'A' as order_origin from {source}"""


STEPS: dict[str, str] = {
    "lines": "select account_name, settlement_id, currency, start_date, end_date, posted_date, coalesce(order_id, '') as order_id, coalesce(sku, '') as sku, "
             "transaction_type, amount_type as fee_category, amount_description as fee_type, amount, quantity_purchased, 'Not Imported' as status from settlements",
    "ranked": f"select *, row_number() over (partition by account_name, settlement_id, {LOCAL_DAY}, lower(order_id), lower(sku), transaction_type, fee_category, fee_type, amount, "
              f"quantity_purchased order by posted_date, order_id, sku) as ranking from lines",
    "numbered": "select *, row_number() over (partition by account_name, settlement_id order by posted_date, order_id, sku, currency, transaction_type, "
                "fee_category nulls first, fee_type nulls first, amount, quantity_purchased nulls first, ranking) as id from ranked",
    "classes": "select coalesce(lower(transaction_type), '') as transaction_type, coalesce(lower(fee_category), '') as fee_category, "
               "coalesce(lower(fee_type), '') as fee_type, min(class_code) as class_code, arg_min(subclass_code, row(class_code, subclass_code)) as subclass_code, count(*) as n from fee_reference group by 1, 2, 3",
    "period": "select account_name, settlement_id, min(start_date) as start_date, max(end_date) as end_date from lines group by 1, 2",
    "canon": f"select * exclude (rn) from (select *, row_number() over (partition by upc order by warehouse) as rn from inventory where {NUMERIC_UPC}) q where rn = 1",
    "pairs": "select distinct asin, upc from product_data where upc not ilike 'b%' and asin is not null",
    "pairs_marketplace": "select distinct asin, upc from product_data where fulfillment_channel = 'AMAZON_NA' and upc not ilike 'b%' and asin is not null",
    "r_orders": resolved("select min(sku) as sku from settlements where sku <> '' group by lower(sku)", "orders"),
    "skus": f"select account_name, min(sku) as sku from settlements where sku <> '' and {LOCAL_DAY} between date '1996-01-01' and date '2001-10-31' group by account_name, lower(sku)",
    "r_report": resolved("select account_name, sku from skus", "report", by_account=True),
    "r_listed": resolved("select min(sku) as sku from settlements where sku <> '' group by lower(sku)", "inventory"),
    "r_events": resolved("select min(sku) as sku from inventory_events group by lower(sku)", "inventory"),
    "r_two": resolved("select min(sku) as sku from settlements where sku <> '' group by lower(sku)", "two_rung"),
    "pairs_all": "select distinct asin, upc from product_data where asin is not null",
    "r_status": resolved("select min(sku) as sku from settlements where sku <> '' group by lower(sku)", "status"),
    "r_since": resolved("select min(sku) as sku from statements where sku <> '' and posted_date_1 >= date '1997-01-01' group by lower(sku)", "two_rung").replace("pairs_marketplace", "pairs"),
    "pending": f"""select distinct account_name, settlement_id from settlements s where status = 'POSTED' and {LOCAL_DAY} >= date '1995-06-01'
        and not exists (select 1 from exported e where e.account_name = s.account_name and e.settlement_id = s.settlement_id)""",
    "r_two_any": resolved("select min(sku) as sku from settlements where sku <> '' group by lower(sku)", "two_rung").replace("pairs_marketplace", "pairs"),
    "fba": rollup("('Order', 'TBYB Order Payment', 'Liquidations', 'Liquidations Adjustments')", "Amazon"),
    "fbm": rollup(ORDER_TYPES, "Merchant"),
    "priced": f"""select o.*, r.division, r.sub_div, r.season, coalesce(r.style, o.sku) as style, r.color, r.pack_dim, r.size,
        {half_up('principal', f"cast(quantity as hugeint) * (case when currency = 'MXN' then {RATE_FX} else {RATE_ONE} end)", 2)} as price_2,
        {half_up('principal', f"cast(quantity as hugeint) * (case when currency = 'MXN' then {RATE_FX} else {RATE_ONE} end)", 4)} as price_4
        from fba o left join r_orders r on lower(r.sku) = lower(o.sku) left join fx_rates fx on fx.settlement_id = o.settlement_id""",
    "sales_all": SALES,
    "credits_all": CREDITS,
    "raw_side": RECON_RAW,
    "logic_side": RECON_LOGIC,
    "report": f"""select s.*, {money("r.total_amount - r.exclusions - r.unmapped - coalesce(l.total_amount, 0)")} as difference
        from (select * from raw_side union all by name select * from logic_side) s
        join raw_side r on r.account_name = s.account_name and r.settlement_id = s.settlement_id
        join logic_side l on l.account_name = s.account_name and l.settlement_id = s.settlement_id""",
    "credit_lines": f"select account_name, settlement_id, currency, start_date, end_date, posted_date, min(order_id) as order_id, min(sku) as sku, transaction_type, fee_category, fee_type, ranking, "
                    f"cast(sum(case when fee_type = 'Principal' then quantity_purchased end) as bigint) as quantity, sum(amount) as total_amount from ranked "
                    f"where {CREDIT_FILTER} group by 1, 2, 3, 4, 5, 6, lower(order_id), lower(sku), 9, 10, 11, 12",
    # stock
    "prepacked": f"""select a.*, b.season as season_1, b.* exclude (division, season) from (select {STOCK} from inventory) a
        left join prepack b on a.division = b.division and a.pack_dim = b.prepack_code and left(a.season, 1) = b.season""",
    "sized": f"{EXPLODED} union all {LOOSE_ROWS}",
    "reset": f"select * replace (case when pack_dim in {LOOSE} then upc else '0' end as upc) from sized",
    "known_upcs": f"select style, color, size_detail, min(upc) as known from reset where {NUMERIC_UPC} group by 1, 2, 3",
    "backfilled": f"""select r.* replace (case when r.upc is null or {NUMERIC_UPC.replace('(upc', '(r.upc')} then r.upc else coalesce(k.known, r.upc) end as upc)
        from reset r left join known_upcs k on k.style = r.style and k.color = r.color and k.size_detail = r.size_detail""",
    "pruned": "select * from backfilled where type = 'NO SIZE' or (size_detail is not null and coalesce(qty, 1) <> 0 and lower(size) = 'ppk')",
    "final_stock": f"""select *, {allocated('avail_in_stock', 'avail_in_stock')} as units_per_size, {allocated('wip', 'wip')} as wip_per_size,
        {allocated('in_transit', 'coalesce(in_transit, 0)')} as in_transit_per_size from pruned""",
    "warehouses": """select a.warehouse, coalesce(b.exclude, '') as exclude, coalesce(b.priority, '') as priority
        from (select distinct warehouse from inventory) a left join warehouse_override b using (warehouse)""",
    "sellable": "select f.* from final_stock f join (select distinct warehouse from warehouses where exclude <> 'X') w using (warehouse)",
    "style_upcs": """select style || color || size_detail as lookup, upc, style, color, size_detail as size, sub_div, sub_div_desc, left(season, 1) as season, right(season, 2) as year
        from (select *, row_number() over (partition by style, color, size_detail, upc order by sub_div, sub_div_desc, left(season, 1), right(season, 2)) as rn from sellable) q where rn = 1""",
    # inventory events
    "event_ledger": f"""select {EVENT}, {EVENT_RANK}, 'Not Imported' as status from inventory_events
        where {EVENT_WINDOW} and transaction_type not in ('Shipments', 'Receipts', 'VendorReturns')""",
    "draft_event_ledger": f"""select {EVENT}, {EVENT_RANK}, 'Not Imported' as status from inventory_events
        where {EVENT_WINDOW} and transaction_type not in ('Shipments', 'Receipts', 'WhseTransfers', 'CustomerReturns')""",
    "converted": f"""select e.*, case when r.product_asin = '' and r.product_id = '' then e.fnsku when r.product_id = '' then r.product_asin else r.product_id end as product_asin,
        r.erp_upc, {', '.join(f"coalesce(r.style, e.sku) as style" if c == 'style' else f'r.{c}' for c in STOCK_ATTRIBUTES if c != 'warehouse')}
        from ({DISTINCT_EVENT.format(ledger='event_ledger')}) e left join r_events r on lower(r.sku) = lower(e.sku)""",
    "adjustments": """select division, left(min(full_season), 1) as season, right(min(full_season), 2) as season_year, min(style) as style, min(sku200) as sku200,
        min(color) as color_code, min(pack_dim) as pack, min(size_scale) as size_scale, min(size) as size,
        cast(sum(quantity) as bigint) as units, 297 as warehouse_in, 297 as warehouse_out, division is not null as connected
        from (select *, season as full_season from converted) c group by division, lower(season), lower(style), lower(color), lower(size), lower(pack_dim), lower(size_scale)""",
    "event_asins": """select s.sku, coalesce(a.asin, i.asin) as asin from (select min(sku) as sku from inventory_events group by lower(sku)) s
        left join (select sku, min(asin) as asin from product_data where asin <> '' group by sku) a on lower(a.sku) = lower(s.sku)
        left join (select upc, min(asin) as asin from product_data where asin <> '' group by upc) i on lower(i.upc) = lower(s.sku)""",
    "event_upcs": """select e.sku, e.asin as product_asin, coalesce(min(c.upc), min(d.upc)) as erp_upc from event_asins e left join pairs p on p.asin = e.asin
        left join canon c on c.upc = p.upc left join canon d on d.upc = substring(p.upc, 2) group by 1, 2""",
    "event_stock": f"""select e.*, {', '.join(f'coalesce(c.{a}, d.{a}) as {a}' for a in STOCK_ATTRIBUTES)} from event_upcs e
        left join canon c on c.upc = e.erp_upc left join canon d on d.upc = substring(e.erp_upc, 2)""",
    # drafts
    "draft_lines": "select * replace (coalesce(order_id, '') as order_id, coalesce(sku, '') as sku), 'Not Imported' as line_status from statements",
    "draft_ranked": f"select {DRAFT_LINE.replace('order_id, sku', "coalesce(order_id, '') as order_id, coalesce(sku, '') as sku")}, {DRAFT_RANK} as ranking from statements",
    "buckets": f"""select a.company_name, min(a.order_id) as order_id, min(a.sku) as sku, min(posted_date) as posted_date, cast(sum(quantity_purchased) as bigint) as quantity,
        {money('sum(amount)')} as total_amount, {money(f'sum(case when {PRICE} then amount else 0 end)')} as principal,
        {money(f'sum(case when {FREIGHT} then amount else 0 end)')} as freight, {money("sum(case when fee_type ilike '%tax%' then amount else 0 end)")} as tax,
        {money(f"sum(case when not {PRICE} and not {FREIGHT} and fee_type not ilike '%tax%' then amount else 0 end)")} as misc, min(o.fulfillment_channel) as fulfillment_channel
        from draft_lines a left join (select distinct order_id, sku, fulfillment_channel from all_orders) o on lower(o.order_id) = lower(a.order_id) and lower(o.sku) = lower(a.sku)
        where transaction_type = 'Order' group by a.company_name, lower(a.order_id), lower(a.sku)""",
    "matched_orders": stock_join("buckets", "r_two", ["listed_upc", "erp_upc", *MERGED]) + " where r.erp_upc is not null",
    "labelled_orders": stock_join("buckets", "r_listed", MERGED),
    "draft_credits": f"""select company_name, posted_date, min(order_id) as order_id, min(sku) as sku, transaction_type, fee_category, fee_type, ranking, cast(sum(quantity_purchased) as bigint) as quantity,
        {money('sum(amount)')} as total_amount from draft_ranked where transaction_type <> 'Order' and coalesce(not {REFUND}, false) group by 1, 2, lower(order_id), lower(sku), 5, 6, 7, 8""",
    "refunds": f"""select company_name, min(order_id) as order_id, min(sku) as sku, min(posted_date) as posted_date,
        cast(sum(case when fee_type = 'Principal' then quantity_purchased else 0 end) as bigint) as quantity, {money('sum(amount)')} as total_amount,
        {money(f'sum(case when {PRICE} then amount else 0 end)')} as principal, {money("sum(case when fee_type ilike '%tax%' then amount else 0 end)")} as tax
        from draft_lines where {REFUND} group by 1, lower(order_id), lower(sku)""",
}
RAW_FULL = f"""select a.account_name, a.settlement_id, a.currency, a.start_date, a.end_date, a.posted_date, a.order_id, a.sku, a.transaction_type,
    a.amount_type as fee_category, a.amount_description as fee_type, a.amount, a.quantity_purchased, a.status,
    r.transaction_type as reference_transaction_type, r.fee_category as reference_fee_category, r.fee_type as reference_fee_type,
    r.id, r.credit_memo_class, r.credit_memo_sub_class, r.notes, r.class_code, r.subclass_code
    from settlements a left join fee_reference r on lower(a.transaction_type) = lower(r.transaction_type)
    and coalesce(lower(a.amount_type), '') = coalesce(lower(r.fee_category), '') and coalesce(lower(a.amount_description), '') = coalesce(lower(r.fee_type), '')"""


def profile(view: str, columns: dict[str, str]) -> str:
    """Type profile, one pass per column. Kinds: text, whole, decimal, date, time."""
    parts = []
    for position, (column, kind) in enumerate(columns.items(), 1):
        if kind == "date":
            target, length, zero = "'DATE'", "0", "false"
        elif kind == "time":
            target, length, zero = f"case when count(*) filter (where {column} <> date_trunc('day', {column})) > 0 then 'DATETIME' else 'DATE' end", "0", "false"
        else:
            t = f"cast({column} as varchar)"
            d = f"try_cast(trim({t}) as decimal(38,10))"
            shown = f"rtrim(rtrim(cast({d} as varchar), '0'), '.')"
            number = rf"({d} is not null and regexp_matches({t}, '^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'))"
            texts = rf"count(*) filter (where {column} is not null and not {number})" if kind == "text" else "0"
            fractions = rf"count(*) filter (where {number} and contains({shown}, '.'))"
            whole = rf"greatest(coalesce(max(length(split_part({shown}, '.', 1))) filter (where {number}), 1), 1)"
            depth = rf"max(greatest(length(split_part({shown}, '.', 2)), 1)) filter (where {number})"
            printed = rf"max(case when contains({shown}, '.') then length({shown}) else length({shown}) + 2 end) filter (where {number})"
            chars = f"max(case when {column} is null then 4 else length({t}) end)"
            length = f"case when {texts} > 0 then {chars} when {fractions} > 0 then {printed} else {whole} end"
            target = f"""case when {texts} > 0 then case when {chars} > 255 then 'TEXT' when {chars} >= 100 then 'VARCHAR(255)' when {chars} >= 50 then 'VARCHAR(100)'
                when {chars} >= 25 then 'VARCHAR(50)' when {chars} >= 15 then 'VARCHAR(25)' when {chars} >= 10 then 'VARCHAR(15)' when {chars} >= 5 then 'VARCHAR(10)' else 'VARCHAR(5)' end
                when {fractions} > 0 then 'NUMERIC(' || case when {length} <= 10 then '12' when {length} <= 20 then '20' else '38' end || ',' || case when {depth} <= 2 then '2' else '4' end || ')'
                when {whole} >= 10 then 'BIGINT' else 'INTEGER' end"""
            zero = f"{texts} = 0 and count(*) filter (where {number} and {d} <> 0) = 0"
        parts.append(f"select {position} as position, '{column}' as column_name, {target} as target_type, cast({length} as bigint) as max_length, "
                     f"count(*) - count({column}) as null_count, {zero} as zero_or_null from {view}")
    return " union all ".join(parts)


SETTLEMENT_KINDS = {
    "account_name": "text", "settlement_id": "whole", "currency": "text", "start_date": "date", "end_date": "date", "posted_date": "time", "order_id": "text",
    "sku": "text", "transaction_type": "text", "amount_type": "text", "amount_description": "text", "amount": "decimal", "quantity_purchased": "whole", "status": "text",
}
STATEMENT_NAMES = "company_name settlement_id settlement_batch start_date end_date posted_date posted_date_1 order_id sku transaction_type fee_category fee_type amount quantity_purchased status".split()
INVENTORY_COLUMNS = "division div_name sub_div sub_div_desc warehouse warehouse_name season style color pack_dim size upc asin carton_qty avail_in_stock wip in_transit cost sku200 size_scale".split()

STEPS["profiled"] = profile("settlements", SETTLEMENT_KINDS)
STEPS["stored_profile"] = profile("warehouse_info", {"warehouse": "whole", "name": "text", "zip_postal_code": "text", "company_number": "text", "trading_partner_id": "text"})
STEPS["incoming_profile"] = profile(
    "(select warehouse, warehouse_name as name, asin as zip_postal_code, cost as company_number, upc as trading_partner_id from inventory)",
    {"warehouse": "whole", "name": "text", "zip_postal_code": "text", "company_number": "decimal", "trading_partner_id": "text"})

STEPS["number_texts"] = """select case p_partkey % 3 when 0 then '.5' when 1 then '1e3' else ' 7' end as spellings, case p_partkey % 2 when 0 then '12345.6' else '1.2345' end as mixed,
    case when p_partkey % 50 = 1 then '12345678901234567890.5' else '1' end as long_number, '007' as padded, case p_partkey % 2 when 0 then '-3.10' else '2' end as signed,
    case when p_partkey % 4 = 0 then 'x1' else cast(p_partkey as varchar) end as words from part"""
STEPS["number_profile"] = profile("number_texts", {c: "text" for c in ("spellings", "mixed", "long_number", "padded", "signed", "words")})

WIDTH = r"try_cast(regexp_extract({}, '\(([0-9]+)\)', 1) as int)"
SPLIT_CREDITS = "select *, not (style is not null and color is null and style <> '') as connected from credits_all"
SPLIT_SALES = "select *, division is not null as connected from sales_all"

PERIOD_LABEL = "cast(p.start_date as varchar) || '_' || cast(p.end_date as varchar) as period"

FINAL: dict[str, str] = {
    # ledger
    "dup_rank": f"select {LINE}, status, ranking from ranked",
    "settlement_line_id": f"select id, {', '.join(c for c in LINE.split(', ') if c not in ('start_date', 'end_date'))}, ranking from numbered",
    "fee_ledger": f"select a.*, c.class_code as credit_memo_class, coalesce(c.n, 1) as line_count from numbered a left join classes c on {CLASS_ON}",
    "join_null_blank": f"""select a.account_name, a.settlement_id, a.order_id, a.sku, a.transaction_type, a.fee_category, a.fee_type, a.amount, r.id, r.class_code
        from lines a left join fee_reference r on lower(a.transaction_type) = lower(r.transaction_type)
        and coalesce(lower(a.fee_category), '') = coalesce(lower(r.fee_category), '') and coalesce(lower(a.fee_type), '') = coalesce(lower(r.fee_type), '')""",
    "raw_settlement_extract": RAW_FULL,
    "settlement_skus": "select * from skus",
    "settlement_period": "select * from period",
    "settlement_calendar": """select *, date_diff('day', start_date, end_date) as date_range from (select account_name, start_date,
        coalesce(lead(start_date) over (partition by account_name order by start_date) - 1, max(last_day) over (partition by account_name)) as end_date
        from (select account_name, start_date + 1 as start_date, max(end_date) as last_day from settlements group by 1, 2) s) t""",
    "pending_settlements": f"""select distinct account_name, settlement_id, start_date, end_date from settlements s where status = 'POSTED' and {LOCAL_DAY} >= date '1995-06-01'
        and not exists (select 1 from exported e where e.account_name = s.account_name and e.settlement_id = s.settlement_id)""",
    "pending_lines": f"""select {', '.join(SETTLEMENT_COLUMNS)} from settlements s where exists (select 1 from settlements p
        where p.account_name = s.account_name and p.settlement_id = s.settlement_id and p.status = 'POSTED' and {LOCAL_DAY.replace('posted_date', 'p.posted_date')} >= date '1995-06-01')
        and not exists (select 1 from exported e where e.account_name = s.account_name and e.settlement_id = s.settlement_id)""",
    "pending_from_files": f"""select distinct account_name, settlement_id, start_date, end_date from settlements s where status = 'POSTED' and {LOCAL_DAY} >= date '1995-06-01'
        and not exists (select 1 from exported e where e.account_name = s.account_name and e.settlement_id = s.settlement_id)""",
    "exported_from_files": "select distinct account_name, settlement_id, start_date, end_date from settlements where end_date < date '1996-01-01'",
    "fee_reference_refresh": """select * from fee_reference union all
        select cast((select max(id) from fee_reference) + row_number() over (order by transaction_type, fee_category, fee_type) as int), *, '', '', '', '', '' from (
        select distinct transaction_type, coalesce(amount_type, '') as fee_category, coalesce(amount_description, '') as fee_type from settlements s
        where not exists (select 1 from classes c where c.transaction_type = lower(s.transaction_type) and c.fee_category = coalesce(lower(s.amount_type), '')
          and c.fee_type = coalesce(lower(s.amount_description), ''))) n""",
    "check_unique_keys": """select order_id, sku, fulfillment_channel, count(*) as key_count from all_orders group by 1, 2, 3
        having count(*) > 1 or order_id is null or sku is null or fulfillment_channel is null""",
    "check_single_period": """select account_name, settlement_id, min(start_date) as start_date, max(end_date) as end_date, count(distinct start_date) as start_dates,
        count(distinct end_date) as end_dates, count(distinct currency) as currencies from lines group by 1, 2""",
    # product match
    "inventory_by_upc": "select * from canon",
    "listing_upc_backfill": """select p.* replace (case when l.product_id not ilike 'b%' then l.product_id else p.upc end as upc) from product_data p
        left join all_listings l on l.account_name = p.account_name and l.seller_sku = p.sku""",
    "missing_upc_report": f"""select sku, listed_asin as asin, case when product_id <> '' then product_id end as product_id, listed_upc as upc, cast(null as varchar) as erp_upc
        from r_report s where erp_upc is null and not (coalesce(listed_upc, '') = '' and exists (select 1 from canon i
        where i.upc = case when length({DIGITS}) = 12 then {DIGITS} else s.sku end))""",
    "upc_match_rungs": "select coalesce(rung, 'none') as rung, count(*) as skus from r_orders group by 1",
    "upc_match_diagnostic": f"""select s.sku, {DIGITS} as sku_digits, coalesce(listed_asin, e.fnsku) as asin, listed_upc as upc, substring(listed_upc, 2) as upc_tail,
        cast(length(listed_upc) - 1 as int) as tail_length, erp_upc from r_listed s left join (select sku, min(fnsku) as fnsku from inventory_events group by 1) e on e.sku = s.sku""",
    "related_products_by_asin": """select p.*, cast(n.order_lines as bigint) as order_lines from product_data p join (select b.asin, count(*) as order_lines from buckets a
        join product_data b on lower(b.sku) = lower(a.sku) where b.asin is not null group by 1) n on n.asin = p.asin""",
    # sales
    "order_rollup_fba": "select * from fba",
    "order_rollup_fbm": "select * from fbm",
    "order_enriched": stock_join("fba", "r_orders", ["product_id", "erp_upc", *MERGED]).replace("r.style", "coalesce(r.style, f.sku) as style"),
    "sales_extract_usd": "select * from sales_all where currency = 'USD'",
    "sales_extract_cad": "select * from sales_all where currency = 'CAD'",
    "sales_extract_mxn": "select * from sales_all where currency = 'MXN'",
    "sales_connected_split": SPLIT_SALES,
    # credits
    "credit_rollup": "select * from credit_lines",
    "credit_enriched": stock_join("credit_lines", "r_orders", ["product_id", "erp_upc", *STOCK_ATTRIBUTES]).replace("r.style", "coalesce(r.style, f.sku) as style"),
    "credit_extract_usd": "select * from credits_all where currency = 'USD'",
    "credit_extract_cad": "select * from credits_all where currency = 'CAD'",
    "credit_extract_mxn": "select * from credits_all where currency = 'MXN'",
    "credit_connected_split": SPLIT_CREDITS,
    # reconciliation
    "recon_raw": "select * from raw_side",
    "recon_logic": "select * from logic_side",
    "recon_report": "select * from report",
    "reconcile_pending": "select * from report r where exists (select 1 from pending p where p.account_name = r.account_name and p.settlement_id = r.settlement_id)",
    "reconciliation_shrinks": "select * replace (case when settlement_id % 3 > 0 then account_name end as account_name) from raw_side where settlement_id % 10 <> 2",
    "check_keyed_inputs": " union all ".join(
        f"select '{name}' as input, concat_ws('|', {', '.join(f"coalesce(lower(cast({k} as varchar)), '')" for k in keys)}) as key_text, count(*) as key_count "
        f"from {view} group by {', '.join(keys)} having count(*) > 1 or {' or '.join(f'{k} is null' for k in keys)}"
        for name, view, keys in (
            ("all_orders", "all_orders", ("order_id", "sku", "fulfillment_channel")), ("exchange_rates", "fx_rates", ("settlement_id",)),
            ("prepack", "prepack", ("division", "prepack_code", "season")), ("warehouse_override", "warehouse_override", ("warehouse",)),
            ("product_data", "product_data", ("account_name", "sku")), ("fee_reference", "fee_reference", ("transaction_type", "fee_category", "fee_type")))),
    "feed_fault_counts": f"""select fault, cast(count(*) as bigint) as rows from (select unnest(string_split(faults, ',')) as fault from ({FAULTY_STOCK}) where faults <> '') group by 1""",
    "feed_rejected_rows": f"select faults, cast(count(*) as bigint) as rows from ({FAULTY_STOCK}) where faults <> '' group by 1",
    "feed_sound_rows": f"select * exclude (faults) from ({FAULTY_STOCK}) where faults = ''",
    "feed_rejects": "select case when warehouse % 4 = 0 then 'warehouse' else '' end as faults, exclude, priority, warehouse from warehouse_override",
    # stock
    "prepack_join": "select * from prepacked",
    "prepack_size_explode": EXPLODED,
    "loose_stock_rows": LOOSE_ROWS,
    "size_upc_backfill": "select * from backfilled",
    "prepack_prune": "select * from pruned",
    "stock_per_size": "select * from final_stock",
    "warehouse_list": "select * from warehouses",
    "sellable_stock": "select * from sellable",
    "style_upc_lookup": "select * from style_upcs",
    "distinct_styles": "select distinct style from sellable",
    # inventory events
    "inventory_event_rank": f"select {EVENT}, {EVENT_RANK} from inventory_events",
    "inventory_event_ledger": "select * from event_ledger",
    "inventory_adjustment_conversion": "select * from converted",
    "inventory_adjustment_extract": "select * from adjustments",
    # drafts
    "daily_principal_total": f"select {money('sum(amount)')} as amount from statements where posted_date_1 = {AS_OF_DAY} - 1 and transaction_type = 'Order' and fee_type = 'Principal'",
    "duplicate_lines": f"""select posted_date_1, order_id, sku, fee_category, fee_type, amount, ranking, count(*) as line_count, '' as active from (
        select *, row_number() over (partition by posted_date_1, lower(order_id), lower(sku), fee_category, fee_type, amount order by order_id, sku) as ranking from statements
        where posted_date_1 > {AS_OF_DAY} - 60) q group by 1, 2, 3, 4, 5, 6, 7""",
    "order_buckets": "select * from buckets",
    "two_rung_match": "select * from matched_orders",
    "order_extract_order_grain": draft_order_extract("matched_orders", "order_id"),
    "order_extract_with_division": draft_order_extract("labelled_orders", "order_id || '_' || coalesce(cast(division as varchar), '')"),
    "sku_match_list": """select sku, product_asin as asin, product_id, listed_upc as upc, erp_upc, listed_upc is not null as has_upc, erp_upc is not null as has_erp_upc from r_two_any""",
    "orders_without_channel": "select * from buckets where fulfillment_channel is null",
    "credit_rollup_line_grain": "select * from draft_credits",
    "credit_extract_line_grain": """select '01' as company, coalesce(r.division, 0) as division, '' as invoice_number, posted_date as invoice_date, left(r.season, 1) as season,
        'EASF02' as customer_number, '0001' as store_number, '' as order_type, order_id || '_' || cast(r.division as varchar) as customer_po_number, 297 as warehouse,
        coalesce(cast(r.sub_div as varchar), '') as sub_division, '' as factor_code, 'RBM' as sales_rea, 'RBM' as sales_rep, '' as terms_code, total_amount as amount,
        transaction_type as misc_description, fee_category as credit_memo_class, fee_type as credit_memo_sub_class, 'AMAZON' as business_unit, '' as y_tax, '' as tax_amount,
        'RBM' as sales_manager, coalesce(r.style, '') as style, '' as fabric, coalesce(r.color, '') as color
        from draft_credits c left join r_two r on lower(r.sku) = lower(c.sku) where r.erp_upc is not null or c.sku = ''""",
    "refund_rollup": "select * from refunds",
    "refund_extract": f"""select '01' as company, r.division, 297 as warehouse, 'EASF02' as customer_number, '0001' as store_number, 'C' as col_1, 'R' as col_2,
        left(r.season, 1) as style_season, '0' as col_3, r.listed_upc as upc, quantity, {money('principal + tax')} as amount, {money('principal + tax')} as amount_1, '0' as col_4,
        '0' as col_5, '' as blank_1, order_id as external_order_number, 'RBM' as col_6, 'S' as col_7, posted_date, '$' as col_8
        from refunds f join r_two r on lower(r.sku) = lower(f.sku) where r.erp_upc is not null""",
    "refund_lines_open": f"""select *, row_number() over (partition by posted_date_1, lower(order_id), lower(sku), fee_category, fee_type, amount order by company_name, settlement_id, settlement_batch,
        start_date, end_date, posted_date, order_id, sku) as ranking from statements where posted_date_1 > {AS_OF_DAY} - 20 and transaction_type = 'Refund' and lower(status) = 'open'
        and quantity_purchased <> 0 and fee_type = 'Principal'""",
    "mark_complete": f"""select l.* exclude (status, line_status), case when (transaction_type = 'Order' or {REFUND}) and r.erp_upc is not null then 'Complete'
        when transaction_type <> 'Order' and not {REFUND} and (r.erp_upc is not null or l.sku = '') then 'Complete' else 'Not Imported' end as status
        from draft_lines l left join r_two r on lower(r.sku) = lower(l.sku)""",
    "mark_orders_by_status_rungs": f"""select l.* exclude (status, line_status), case when (transaction_type = 'Order' or {REFUND}) and r.erp_upc is not null then 'Complete'
        when transaction_type <> 'Order' and not {REFUND} and (r.erp_upc is not null or l.sku = '') then 'Complete' else 'Not Imported' end as status
        from draft_lines l left join r_status r on lower(r.sku) = lower(l.sku)""",
    "sku_match_list_since": """select sku, product_asin as asin, product_id, listed_upc as upc, erp_upc, listed_upc is not null as has_upc, erp_upc is not null as has_erp_upc from r_since""",
    "recent_order_principals": f"""select *, row_number() over (partition by posted_date_1, lower(order_id), lower(sku), fee_category, fee_type, amount order by company_name, settlement_id,
        settlement_batch, start_date, end_date, posted_date, order_id, sku) as ranking from statements
        where posted_date_1 > {AS_OF_DAY} - 20 and transaction_type = 'Order' and fee_type = 'Principal'""",
    "settlement_day_lookup": """select *, (posted_date at time zone 'US/Eastern') at time zone 'US/Pacific' as posted_at_target from statements
        where settlement_id in (select settlement_id from exported) and cast((posted_date at time zone 'US/Eastern') at time zone 'US/Pacific' as date) = date '1995-03-15'""",
    "mark_events_complete": f"select {', '.join('l.' + c for c in EVENT.split(', '))}, ranking, case when e.erp_upc is not null then 'Complete' else status end as status from draft_event_ledger l left join event_stock e on lower(e.sku) = lower(l.sku)",
    "stock_adjustment_draft": f"""select s.division, left(s.season, 1) as season, right(s.season, 2) as season_year, s.style, s.sku200, '' as blank_1, s.color, s.pack_dim as size_scale, s.size,
        e.quantity, 297 as warehouse_in, 297 as warehouse_out from ({DISTINCT_EVENT.format(ledger='draft_event_ledger')}) e left join event_stock s on lower(s.sku) = lower(e.sku)
        where s.erp_upc is not null or e.sku = ''""",
    "local_day_totals": f"""select company_name, transaction_type, fee_category, fee_type, {money('sum(amount)')} as amount from statements
        where cast(posted_date - interval 3 hour as date) = date '1998-06-15' group by 1, 2, 3, 4""",
    "local_day_ledger": f"""select row_number() over (partition by company_name order by posted_date, order_id, sku, transaction_type, fee_category nulls first, fee_type nulls first, amount,
        quantity_purchased nulls first, ranking) as id, * from (select {DRAFT_LINE.replace('order_id, sku', "coalesce(order_id, '') as order_id, coalesce(sku, '') as sku")},
        {DRAFT_RANK} as ranking, posted_date - interval 3 hour as posted_at_target, cast(1 as bigint) as line_count, 'Not Imported' as status from statements
        where cast(posted_date - interval 3 hour as date) = date '1998-06-15') q""",
    "settlement_day_total": f"""select company_name, settlement_id, settlement_batch, {money('sum(amount)')} as amount from statements
        where posted_date_1 = date '1998-06-15' group by 1, 2, 3""",
    "zone_comparison": f"""select settlement_id, settlement_batch, (posted_date at time zone 'US/Eastern') at time zone 'UTC' as posted_utc, posted_date,
        posted_date + interval 5 hour as posted_plus_five, min(order_id) as order_id, transaction_type, {money('sum(amount)')} as amount from statements
        where cast(posted_date - interval 3 hour as date) = date '1998-06-15' group by 1, 2, 3, 4, 5, lower(order_id), 7""",
    "statement_discrepancy": f"""select settlement_id, settlement_batch, start_date, end_date, max(total_amount) as total_amount, {money('sum(amount)')} as amount,
        max(total_amount) = sum(amount) as matched, {money('max(total_amount) - sum(amount)')} as discrepancy from statement_lines group by 1, 2, 3, 4""",
    "order_lookup": "select * from settlements where lower(order_id) in (select 'ord-' || cast(o_orderkey as varchar) from orders where o_orderpriority = '1-URGENT')",
    "order_sku_representative": f"""select * exclude (rn, spelled_order, spelled_sku) replace (spelled_order as order_id, spelled_sku as sku) from (select *,
        min(order_id) over (partition by lower(order_id), lower(sku)) as spelled_order, min(sku) over (partition by lower(order_id), lower(sku)) as spelled_sku,
        row_number() over (partition by lower(order_id), lower(sku) order by company_name, settlement_id, settlement_batch, start_date, end_date,
        posted_date, posted_date_1, transaction_type, fee_category nulls first, fee_type nulls first, amount, quantity_purchased nulls first, status) as rn
        from statements where posted_date_1 = {AS_OF_DAY} - 2 and transaction_type = 'Order') q where rn = 1""",
    # quality
    "profile_column_types": "select * from profiled",
    "profile_number_texts": "select * from number_profile",
    "profile_merged": "select * from profiled",
    "profile_wide_numbers": """select unnest([1, 2, 3, 4, 5, 6]) as position, unnest(['thirty_digits', 'huge', 'huge_text', 'wide_fraction', 'too_wide', 'halves']) as column_name,
        unnest(['NUMERIC(38,2)', 'DOUBLE', 'VARCHAR(10)', 'NUMERIC(38,2)', 'VARCHAR(50)', 'NUMERIC(12,2)']) as target_type,
        unnest([31, digits + 40, digits + 40, 33, 45, 3]) as max_length, unnest([0, 0, 0, 0, 0, evens]) as null_count, false as zero_or_null
        from (select max(length(cast(p_partkey as varchar))) as digits, count(*) filter (p_partkey % 2 = 0) as evens from part)""",
    "schema_missing_columns": f"""select column_name, case when target_type like 'NUMERIC%' then replace(target_type, 'NUMERIC', 'FLOAT') when target_type = 'INTEGER' then 'INT'
        when target_type = 'DATETIME' then 'DATE' when target_type = 'BOOLEAN' then 'BOOL' else target_type end as ddl_type
        from profiled where column_name not in ({', '.join(f"'{c}'" for c in STATEMENT_NAMES)})""",
    "schema_widening_plan": f"""select column_name, stored_type, target_type, action, case when action = 'keep' then stored_type else target_type end as new_type from (
        select s.column_name, s.target_type as stored_type, i.target_type, case when s.target_type = i.target_type then 'keep'
        when s.target_type = 'BIGINT' and i.target_type = 'INTEGER' then 'keep'
        when s.target_type like 'VARCHAR%' and i.target_type like 'VARCHAR%' then case when {WIDTH.format('i.target_type')} > {WIDTH.format('s.target_type')} then 'widen' else 'keep' end
        when s.target_type like 'VARCHAR%' and i.target_type in ('INTEGER', 'BIGINT', 'BOOLEAN') or s.target_type like 'VARCHAR%' and i.target_type like 'NUMERIC%' then 'keep'
        when i.zero_or_null then 'keep' else 'change' end as action from stored_profile s join incoming_profile i using (column_name)) q""",
    "normalize_headers": "select * from warehouse_info",
    "null_normalize": "select " + ", ".join(
        c if c == "cost" else f"coalesce({c}, 0) as {c}" if c in ("division", "sub_div", "warehouse", "carton_qty", "avail_in_stock", "wip", "in_transit")
        else f"case when {c} is null or {c} = 'None' then '' else {c} end as {c}" for c in INVENTORY_COLUMNS) + " from inventory",
    # sources and sinks
    "sink_full_refresh": "select * from settlements",
    "ingest_new_files": "select * from settlements",
    "export_sales_files": f"select s.*, {PERIOD_LABEL} from ({SPLIT_SALES}) s join period p using (account_name, settlement_id)",
    "export_credit_files": f"select s.*, {PERIOD_LABEL} from ({SPLIT_CREDITS}) s join period p using (account_name, settlement_id)",
    "export_fbm_files": f"select s.*, {PERIOD_LABEL} from (select account_name, cast(settlement_id as varchar) as settlement_id, currency, cast(start_date as varchar) as start_date, cast(end_date as varchar) as end_date, "
                        "order_id, sku, cast(posted_date as varchar) as posted_date, cast(quantity as varchar) as quantity, cast(cast(total_amount as decimal(22,2)) as varchar) as total_amount, "
                        "cast(cast(principal as decimal(22,2)) as varchar) as principal, cast(cast(tax as decimal(22,2)) as varchar) as tax, fulfillment_channel from fbm) s "
                        "join period p on p.account_name = s.account_name and cast(p.settlement_id as varchar) = s.settlement_id",
    "export_inventory_adjustments": "select * from adjustments",
    "export_raw_settlement": RAW_FULL,
    "export_missing_upc": "",
    "export_inventory": "select * from sellable",
    "export_upcs": "select * from style_upcs",
    "export_warehouses": "select * from warehouses",
    "export_warehouse_addresses": "select * from warehouse_info",
    "export_styles": "select distinct style from sellable",
    "export_reconciliation": "select * from report",
    "src_inventory_feed": "select * from inventory",
    "src_statements_in_blocks": """select * replace (amount_description || chr(10) || '"' || coalesce(order_id, '') || '",' as amount_description) from settlements""",
    "src_prepack_feed": "select * from prepack",
    "src_upc_sku": "select * from upc_sku",
    "src_warehouse_info": "select * from warehouse_info",
    "src_warehouse_override": "select * from warehouse_override",
    "src_fee_reference": "",
    "src_fx_rates": "select * from fx_rates",
    "union_store_codes": "select c_mktsegment as store, cast(c_custkey as varchar) as code, case when c_mktsegment <> 'BUILDING' then c_name end as name, "
                         "case when c_mktsegment <> 'AUTOMOBILE' then cast(c_nationkey as varchar) end as region from customer",
}
FINAL["export_missing_upc"] = FINAL["missing_upc_report"]
FINAL["src_fee_reference"] = FINAL["fee_reference_refresh"]


def _needed(text: str, known: dict[str, str]) -> list[str]:
    """Names of the expressions a text uses, each after the ones it builds on."""
    order: list[str] = []

    def visit(body: str) -> None:
        words = set(re.findall(r"[a-z_]+", body))
        for name, inner in known.items():
            if name in words and name not in order and inner is not body:
                visit(inner)
                if name not in order:
                    order.append(name)

    visit(text)
    return order


def oracle_queries() -> dict[str, str]:
    known = {**VIEWS, **STEPS}
    texts = {}
    for name, final in FINAL.items():
        with_clause = ", ".join(f"{step} as ({known[step]})" for step in _needed(final, known))
        text = f"with {with_clause} {final}" if with_clause else final
        # text keys are compared without accents as well
        texts[name] = re.sub(r"\blower\(([a-z_0-9.]+)\)", r"strip_accents(lower(\1))", text)
    return texts
