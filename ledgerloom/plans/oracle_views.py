"""DuckDB text of the derived tables, one common table expression each."""

from __future__ import annotations

from ledgerloom.params import PREPACK_SLOTS
from ledgerloom.plans.dataset import FEE_REFERENCE


def _sku(key: str) -> str:
    return (
        f"case {key} % 7 when 4 then 'AB-' || cast(100000000000 + {key} as varchar) "
        f"when 5 then 'AB-0' || cast(100000000000 + {key} as varchar) else 'SKU-' || cast({key} as varchar) end"
    )


def _asin(key: str) -> str:
    return f"'B0' || lpad(cast({key} as varchar), 8, '0')"


def _keys(party: str, day: str) -> str:
    cur = f"(case when {party} % 10 < 6 then 0 when {party} % 10 < 9 then 1 else 2 end)"
    ym = f"(year({day}) * 100 + month({day}))"
    return (
        f"'acct_' || cast({party} % 3 as varchar) as account_name, "
        f"cast({ym} * 100 + {party} % 3 * 10 + {cur} as bigint) as settlement_id, "
        f"case {cur} when 0 then 'USD' when 1 then 'CAD' else 'MXN' end as currency, "
        f"cast(date_trunc('month', {day}) as date) as start_date, last_day(cast({day} as date)) as end_date, "
        f"case when {ym} >= 200110 then 'OPEN' else 'POSTED' end as status"
    )


def _text(value: object) -> str:
    if value is None:
        return "null"
    return str(value) if isinstance(value, int) else "'" + str(value) + "'"


_HEAD = "account_name, settlement_id, currency, start_date, end_date, posted_date, order_id, sku, transaction_type"
_SIGN = "(case when transaction_type = 'Refund' then -1 else 1 end)"


def _fee(category: str, fee_type: str, amount: str, quantity: str = "null", where: str = "true") -> str:
    head = _HEAD.replace("order_id", "replace(lower(order_id), 'o', 'ó') as order_id") if fee_type == "Tax" else _HEAD.replace("sku", "replace(lower(sku), 'u', 'ú') as sku") if "Promotion" in category else _HEAD
    return (f"select {head}, {category} as amount_type, '{fee_type}' as amount_description, "
            f"cast({amount} as decimal(12,2)) as amount, cast({quantity} as int) as quantity_purchased, status from item where {where}")


VIEWS: dict[str, str] = {
    "item": f"""select {_keys('l_suppkey', 'l_shipdate')}, l_shipdate + to_hours(l_linenumber) as posted_date,
        'ORD-' || cast(l_orderkey as varchar) as order_id, {_sku('l_partkey')} as sku,
        case when l_returnflag = 'R' then 'Refund' when l_linenumber = 7 then 'Liquidations'
          when l_linenumber = 6 and l_linestatus = 'F' then 'TBYB Order Payment' else 'Order' end as transaction_type,
        cast(l_extendedprice as decimal(12,2)) as price, cast(l_tax as decimal(4,2)) as tax,
        cast(l_discount as decimal(4,2)) as disc, cast(l_quantity as int) as qty, l_linestatus from lineitem""",
    "settlements": " union all ".join([
        _fee("case when transaction_type = 'Liquidations' then 'PRICE_TYPE' else 'ItemPrice' end", "Principal", f"price * {_SIGN}", "qty"),
        _fee("'ItemPrice'", "Tax", f"round(price * tax, 2) * {_SIGN}"),
        _fee("'ItemFees'", "Commission", "-round(price * disc, 2)"),
        _fee("'ItemFees'", "Commission", "-round(price * disc, 2)", where="tax = 0"),
        _fee("'Promotion'", "Principal", "-round(price * cast(0.01 as decimal(4,2)), 2)", "qty", "disc = 0.10"),
        _fee("'ItemFees'", "FBAPerUnitFulfillmentFee", "-qty * cast(0.50 as decimal(4,2))", where="l_linestatus = 'F'"),
        f"""select {_HEAD}, null, null, amount, null, status from (select {_keys('o_custkey', 'o_orderdate')},
        o_orderdate as posted_date, cast(null as varchar) as order_id, cast(null as varchar) as sku,
        case o_orderpriority when '1-URGENT' then 'Payable to Amazon' when '2-HIGH' then 'Previous Reserve Amount Balance' when '3-MEDIUM' then 'Current Reserve Amount'
          when '5-LOW' then 'Storage Fee' else 'Subscription Fee' end as transaction_type,
        cast(-round(cast(o_totalprice as decimal(12,2)) * cast(0.01 as decimal(4,2)), 2) as decimal(12,2)) as amount
        from orders) f""",
    ]),
    "statements": """select account_name as company_name, settlement_id, settlement_id * 10 + 1 as settlement_batch, start_date, end_date,
        posted_date, cast(posted_date as date) as posted_date_1, order_id, sku, transaction_type,
        case amount_type when 'ItemPrice' then 'PRICE_TYPE' when 'ItemFees' then 'ITEM_RELATED_FEE_TYPE' else amount_type end as fee_category,
        amount_description as fee_type, amount, quantity_purchased, status from settlements""",
    "statement_lines": """select settlement_id, settlement_batch, start_date, end_date, cast(null as decimal(34,2)) as total_amount, amount from statements
        union all select settlement_id, settlement_batch, start_date, end_date,
        cast(sum(case when transaction_type = 'Storage Fee' and posted_date_1 = end_date then 0 else amount end) as decimal(34,2)), 0
        from statements group by 1, 2, 3, 4""",
    "fee_reference": "select * from (values " + ", ".join("(" + ", ".join(_text(v) for v in row) + ")" for row in FEE_REFERENCE)
        + ") as r(id, transaction_type, fee_category, fee_type, credit_memo_class, credit_memo_sub_class, notes, class_code, subclass_code)",
    "fx_rates": """select distinct settlement_id, cast(cast(1700 + settlement_id % 97 as decimal(10,0)) * cast(0.01 as decimal(4,2)) as decimal(20,10)) as exchange_value
        from settlements where currency = 'MXN' and month(end_date) <> 12""",
    "product_data": f"""select account_name, {_sku('p_partkey')} as sku, case when p_partkey % 7 <= 3 then {_asin('p_partkey')} end as asin,
        case p_partkey % 7 when 0 then '' when 1 then case when account_name <> 'acct_2' then cast(100000000000 + p_partkey as varchar) end
        when 2 then '0' || cast(100000000000 + p_partkey as varchar) when 3 then {_asin('p_partkey')} end as upc,
        case when p_size <= 25 then 'AMAZON_NA' else 'DEFAULT' end as fulfillment_channel
        from part cross join (values ('acct_0'), ('acct_1'), ('acct_2')) as a(account_name)""",
    "all_listings": f"""select account_name, {_sku('p_partkey')} as seller_sku, case when p_size <= 20 then cast(100000000000 + p_partkey as varchar)
        when p_size <= 40 then {_asin('p_partkey')} end as product_id from part cross join (values ('acct_0'), ('acct_1')) as a(account_name)""",
    "all_orders": f"""select 'ORD-' || cast(l_orderkey as varchar) as order_id, {_sku('l_partkey')} as sku,
        case l_orderkey % 5 when 0 then 'Merchant' when 1 then null else 'Amazon' end as fulfillment_channel from lineitem""",
    "inventory": f"""select case when p_size < 50 then cast(replace(p_brand, 'Brand#', '') as int) end as division, p_brand as div_name,
        cast(p_size % 7 as int) as sub_div, 'SD' || cast(p_size % 7 as varchar) as sub_div_desc, warehouse, 'WH ' || cast(warehouse as varchar) as warehouse_name,
        substring(p_type, 1, 1) || cast(20 + p_partkey % 5 as varchar) as season, p_type as style,
        case when p_size <> 33 then split_part(p_name, ' ', 1) end as color,
        case when p_size <= 12 then 'PP1' when p_size <= 40 then 'M' when p_size <= 45 then 'W' else 'OTH' end as pack_dim,
        case when p_size <= 10 then 'PPK' when p_size < 49 then cast(p_size as varchar) end as size,
        case when p_partkey % 7 = 6 then '0' else cast(100000000000 + p_partkey as varchar) end as upc,
        case when p_partkey % 7 in (0, 3) then {_asin('p_partkey')} end as asin, cast(p_size * 2 as int) as carton_qty,
        cast(p_size * 12 as int) as avail_in_stock, case when p_size % 9 > 0 then cast(p_size % 9 as int) end as wip,
        case when p_size % 5 > 0 then cast(p_size as int) end as in_transit, cast(p_retailprice as decimal(12,2)) as cost,
        case when p_size % 3 > 0 then 'K' || cast(p_size % 3 as varchar) end as sku200, 'SC' || cast(p_size % 4 as varchar) as size_scale
        from part join (values ('STANDARD', 297), ('STANDARD', 298), ('SMALL', 300), ('', 297)) as w(kind, warehouse)
          on w.kind = case when p_type in ('STANDARD', 'SMALL') then p_type else '' end""",
    "prepack": """select division, 'PP1' as prepack_code, season, 'A' || season as size_scale_1, cast(null as varchar) as size_scale_2,
        cast(null as varchar) as size_scale_3, 'Prepack ' || season as prepack_desc, cast(case when division = 5 then 0 else 24 end as int) as total_units, """
        + ", ".join(f"case when {i} <= 5 + division then 'S{i}' end as size_{i}, cast(case when {i} <= 5 + division then {i} % 4 end as int) as qty_{i}"
                    for i in range(1, PREPACK_SLOTS + 1))
        + " from (select distinct cast(replace(p_brand, 'Brand#', '') as int) as division, substring(p_type, 1, 1) as season from part) p",
    "warehouse_info": """select cast(290 + s_suppkey as int) as warehouse, s_name as name, s_name || ' Street' as address_1,
        'City ' || cast(s_nationkey as varchar) as city_state, 'US' as country, cast(10000 + s_suppkey as varchar) as zip_postal_code, 'USD' as currency,
        'W' as whse_type, '1' as company_number, 'L' || cast(s_suppkey as varchar) as warehouse_locator, 'T' || cast(s_suppkey as varchar) as trading_partner_id
        from supplier""",
    "warehouse_override": """select cast(290 + n_nationkey as int) as warehouse, case when n_regionkey = 0 then 'X' end as exclude,
        case when n_regionkey > 1 then cast(n_regionkey as varchar) end as priority from nation""",
    "upc_sku": f"select cast(100000000000 + p_partkey as varchar) as upc, {_sku('p_partkey')} as sku, p_type as style from part",
    "inventory_events": f"""select 'acct_' || cast(user_id % 3 as varchar) as company_name, cast(ts as date) as event_date,
        case event_type when 'click' then 'Adjustments' when 'view' then 'Shipments' when 'purchase' then 'CustomerReturns'
          when 'signup' then 'VendorReturns' else 'Receipts' end as transaction_type,
        {_asin('user_id')} as fnsku, case when event_type = 'click' then replace(lower({_sku('user_id')}), 'k', 'ķ') else {_sku('user_id')} end as sku,
        case when value < 10 then 'fć' else 'FC' end || cast(user_id % 5 as varchar) as fulfillment_center_id,
        cast(case when value < 20 then -1 else 1 end as int) as quantity, case when value >= 40 then 'DEFECTIVE' else 'SELLABLE' end as disposition from events""",
    "exported": "select distinct account_name, settlement_id from settlements where end_date < date '1996-01-01'",
}
