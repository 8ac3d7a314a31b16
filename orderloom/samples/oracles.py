"""The registered queries once more as plain SQL over the given tables, for an independent engine."""

from __future__ import annotations

# Orders as the library stores them, and what it derives further from the same line items.
FACTS = """f as (
  select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as order_id,
         o_orderdate as order_timestamp, l_shipdate as event_timestamp,
         c_custkey as customer_id, p_partkey as product_id, s_suppkey as store_id,
         cn.n_name as customer_city, cr.r_name as customer_region,
         p_name as product_name, p_type as category, p_brand as brand,
         sn.n_name as store_city, sr.r_name as store_region,
         cast(l_quantity as int) as quantity, cast(p_retailprice as decimal(12,2)) as unit_price,
         cast(round(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)), 2) as decimal(12,2))
           as tax_amount,
         cast(l_extendedprice as decimal(12,2)) as final_amount,
         o_orderpriority as payment_method,
         case when l_returnflag = 'R' then 'Returned' when o_orderstatus = 'P' then 'Cancelled'
              when l_linestatus = 'F' then 'Delivered' else 'Shipped' end as order_status,
         o_orderkey % 5 = 0 as is_first_order,
         make_timestamp(2001, 7, day(o_orderdate), l_linenumber, 0, 0) as july_time,
         l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag,
         l_linestatus, l_orderkey, l_linenumber, o_custkey, o_orderkey, o_orderstatus, o_orderpriority,
         c_name, c_mktsegment, p_size, s_name, s_acctbal
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation cn on c_nationkey = cn.n_nationkey
  join region cr on cn.n_regionkey = cr.r_regionkey
  join part on l_partkey = p_partkey
  join supplier on l_suppkey = s_suppkey
  join nation sn on s_nationkey = sn.n_nationkey
  join region sr on sn.n_regionkey = sr.r_regionkey
)"""

ARRIVAL = ("l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, "
           "l_linestatus, l_orderkey, l_linenumber")

# Raw events: every field as text, with flaws.
RAW = f"""{FACTS}, r as (
  select case when l_quantity = 50 and l_linenumber = 7 then null else order_id end as order_id,
    case when l_quantity = 44 and l_linenumber = 1 then null
         else strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') end as event_timestamp,
    case when l_linenumber = 6 and l_returnflag = 'N' then 'garbage'
         when l_linestatus = 'O' then strftime(july_time, '%Y-%m-%dT%H:%M:%S') || '.250000'
         else strftime(july_time, '%Y-%m-%dT%H:%M:%S') end as order_timestamp,
    cast(customer_id as varchar) as customer_id, cast(product_id as varchar) as product_id,
    cast(store_id as varchar) as store_id, customer_city, customer_region, product_name, brand,
    store_city, store_region,
    case when o_orderpriority = '5-LOW' then 'unknown' else cast(18 + o_custkey % 48 as varchar) end as customer_age,
    case c_mktsegment when 'MACHINERY' then 'Other' when 'HOUSEHOLD' then 'Female' else 'Male' end
      as customer_gender,
    case when p_size = 1 then null when l_linenumber = 7 and l_returnflag = 'R' then lower(category)
         when l_returnflag = 'A' then ' ' || category || chr(9) else category end as category,
    case when p_size = 50 then null when p_size = 49 then '-1.00' else cast(unit_price as varchar) end
      as unit_price,
    case when s_acctbal < 0 then 'Offline' when s_acctbal < 5000 then 'Online' else 'Hybrid' end as store_type,
    case l_quantity when 50 then '0' when 49 then 'abc' when 48 then '-1' when 47 then null when 46 then '45.5'
         else cast(quantity as varchar) end as quantity,
    case when l_discount = 0.09 and l_linenumber = 2 then null else cast(final_amount as varchar) end
      as total_amount,
    cast(final_amount * cast(l_tax as decimal(4,2)) as varchar) as tax_amount,
    case when l_discount = 0.1 then '0.004' when l_discount = 0.05 then '  ' || cast(final_amount as varchar) || ' '
         else cast(final_amount as varchar) || '5' end as final_amount,
    case when l_linenumber = 5 then null else order_status || ' ' end as order_status,
    case when o_orderstatus = 'P' and l_linenumber = 4 then null else o_orderpriority end as payment_method,
    case when l_linenumber = 3 then null else cast(o_orderkey % 5 = 0 as varchar) end as is_first_order,
    case when l_linestatus = 'O' then 'Mobile' else 'Desktop' end as device_type,
    case when l_returnflag = 'A' then 'App' else 'Website' end as source,
    l_linenumber = 7 and l_discount = 0.01 as cut,
    case when l_shipdate < timestamp '1997-07-01' then 0 when l_shipdate < timestamp '1999-07-01' then 1
         else 2 end as wave,
    l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus,
    l_orderkey, l_linenumber
  from f)"""


def _money(name: str) -> str:
    return f"try_cast(round_even(try_cast(trim({name}) as double) * 100, 0) / 100 as decimal(12,2))"


def _typed(batch: str) -> str:
    """CTE ``t``: typed fields, and the position of each copy within its batch."""
    return f"""t as (
  select order_id, try_cast(order_timestamp as timestamp) as order_timestamp,
    try_cast(event_timestamp as timestamp) as event_timestamp, customer_id, product_id, store_id,
    coalesce(trim(customer_city), 'None') as customer_city,
    coalesce(trim(customer_region), 'None') as customer_region,
    cast(round(try_cast(customer_age as double)) as int) as customer_age, customer_gender, product_name,
    coalesce(trim(category, ' ' || chr(9)), 'None') as category, brand, coalesce(trim(store_type), 'None')
      as store_type, store_city, store_region,
    cast(round(try_cast(quantity as double)) as int) as quantity, {_money("unit_price")} as unit_price,
    {_money("total_amount")} as total_amount, {_money("tax_amount")} as tax_amount,
    {_money("final_amount")} as final_amount, coalesce(trim(payment_method), 'None') as payment_method,
    coalesce(trim(order_status), 'None') as order_status,
    coalesce(cast(is_first_order as boolean), false) as is_first_order, device_type, source,
    cast(round_even(cast({_money("final_amount")} as double) / nullif(try_cast(quantity as double), 0) * 100, 0)
         / 100 as decimal(12,2)) as revenue_per_unit,
    cast(hour(try_cast(order_timestamp as timestamp)) as bigint) as order_hour, wave, cut,
    quantity as raw_quantity, final_amount as raw_amount, category as raw_category,
    row_number() over (partition by order_id, {batch}, cut order by {ARRIVAL}) as copy
  from r)"""


CATEGORIES = "('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')"
_RULES = [
    ("null_order_id", "order_id is null"),
    ("bad_quantity", "coalesce(quantity, 0) <= 0"),
    ("bad_amount", "coalesce(final_amount, 0) <= 0"),
    ("bad_timestamp", "order_timestamp is null"),
    ("unknown_category", f"category not in {CATEGORIES}"),
]
_TABLE_RULES = [
    ("null_event_timestamp", "event_timestamp is null"),
    ("null_unit_price", "unit_price is null"),
    ("null_total_amount", "total_amount is null"),
    ("negative_unit_price", "unit_price < 0"),
]
_LINKS = [
    ("orphan_customer", "customer_id not in (select customer_id from customers)"),
    ("orphan_product", "product_id not in (select product_id from products)"),
    ("orphan_store", "store_id not in (select store_id from stores)"),
]


def _list(rules: list[tuple[str, str]]) -> str:
    return "concat_ws(',', " + ", ".join(f"case when {test} then '{name}' end" for name, test in rules) + ")"


def _reasons(rules: list[tuple[str, str]], links: list[tuple[str, str]] = ()) -> str:
    """Foreign keys are looked up for every row, the other rules only for the first copies."""
    own = f"case when cut then 'corrupt_json' when copy > 1 then 'duplicate_in_batch' else {_list(rules)} end"
    if not links:
        return own
    found = f"(case when cut then '' else {_list(links)} end)"
    return f"concat_ws(',', nullif({own}, ''), nullif({found}, ''))"


def _clean(rules, uncut: bool = True) -> str:
    raw = RAW + (", r0 as (select * replace (false as cut) from r)" if uncut else "")
    typed = _typed("1").replace("from r)", "from r0)") if uncut else _typed("1")
    return f"with {raw}, {typed}, tagged as (select *, {_reasons(rules)} as reject_reasons from t)"


_REJECT_COLUMNS = """order_id, customer_id, product_id, store_id, raw_quantity as quantity,
  raw_amount as final_amount, raw_category as category, split_part(reject_reasons, ',', 1) as reject_reason,
  reject_reasons"""
_ORDER_COLUMNS = """order_id, order_timestamp, event_timestamp, customer_id, product_id, store_id, customer_city,
  customer_region, cast(customer_age as bigint) as customer_age, customer_gender, product_name, category, brand,
  store_type, store_city, store_region, cast(quantity as bigint) as quantity, cast(unit_price as double)
  as unit_price, cast(total_amount as double) as total_amount, cast(tax_amount as double) as tax_amount,
  cast(final_amount as double) as final_amount, payment_method, order_status, is_first_order, device_type, source,
  cast(revenue_per_unit as double) as revenue_per_unit, order_hour"""

# Master data, the part of it that meets its constraints, and the reasons for the rest.
MASTERS = """customer_master as (
  select cast(c_custkey as varchar) as customer_id,
    case when cast(floor(c_acctbal) as bigint) % 97 = 0 then null else c_name end as name,
    case when c_acctbal < 0 then null
         else lower(c_mktsegment) || '.' || cast(cast(floor(c_acctbal) as bigint) as varchar) || '@example.org' end
      as email, n_name as city, r_name as region, cast(floor(floor(c_acctbal) / 80) as int) as age,
    case c_mktsegment when 'MACHINERY' then 'Machine' when 'HOUSEHOLD' then 'Female' else 'Male' end as gender,
    c_custkey as arrival
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
customer_tags as (
  select *, concat_ws(',', case when name is null then 'null_name' end,
      case when age not between 0 and 120 then 'bad_age' end,
      case when gender not in ('Male', 'Female', 'Other') then 'bad_gender' end) as reasons,
    row_number() over (partition by email order by arrival) > 1 and email is not null as repeated
  from customer_master),
customers as (select * from customer_tags where reasons = '' and not repeated),
product_master as (
  select cast(p_partkey as varchar) as product_id, p_name as name, p_type as category, p_brand as brand,
    cast(p_retailprice as decimal(12,2)) as original_price, p_size * 2 as discount_pct,
    cast(p_size / 9.0 as decimal(3,1)) as rating
  from part),
product_tags as (
  select *, concat_ws(',', case when discount_pct not between 0 and 100 then 'bad_discount_pct' end,
      case when rating not between 1 and 5 then 'bad_rating' end) as reasons from product_master),
products as (select * from product_tags where reasons = ''),
store_master as (
  select cast(s_suppkey as varchar) as store_id, s_name as store_name, n_name as city, r_name as region,
    case when s_acctbal < 0 then 'Depot' when s_acctbal < 5000 then 'Online' else 'Hybrid' end as store_type
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
store_tags as (
  select *, case when store_type not in ('Online', 'Offline', 'Hybrid') then 'bad_store_type' else '' end as reasons
  from store_master),
stores as (select * from store_tags where reasons = '')"""

# The stream: within a wave the first copy of an id is judged, over all waves the first accepted one is stored.
STREAM = f"""with {RAW}, {MASTERS}, {_typed("wave")},
tagged as (select *, {_reasons(_RULES + _TABLE_RULES, _LINKS)} as reject_reasons from t),
accepted as (select *, row_number() over (partition by order_id order by wave) as attempt
             from tagged where reject_reasons = ''),
stored as (select * from accepted where attempt = 1)"""

# The same with orders placed in all the real months, copies of an order on different days.
_JULY = "make_timestamp(2001, 7, day(o_orderdate), l_linenumber, 0, 0)"
_MONTHS = """(date_trunc('month', o_orderdate)::timestamp + to_days(cast(day(l_shipdate) % 2 as int))
           + to_hours(l_linenumber))"""
MONTHS = STREAM.replace(_JULY, _MONTHS)
assert MONTHS != STREAM

# Half-up mean of positive cent amounts in whole numbers, as a floating-point average loses half-cent ties.
MEAN = "cast((cast(sum(final_amount) * 100 as bigint) * 2 + count(*)) // (2 * count(*)) as double) / 100"
REVENUE = "order_status not in ('Cancelled', 'Returned')"
AS_OF = "timestamp '2001-08-01 00:00:00'"


def _summary(source: str) -> str:
    return f"""
select cast(order_timestamp as date) as summary_date, category, customer_region as region,
  count(*) as total_orders, cast(sum(final_amount) as double) as total_revenue,
  cast(sum(tax_amount) as double) as total_tax, {MEAN} as avg_order_value,
  cast(sum(quantity) as bigint) as total_quantity, count(distinct customer_id) as unique_customers,
  count(*) filter (is_first_order) as new_customers,
  count(*) filter (order_status = 'Delivered') as delivered_count,
  count(*) filter (order_status = 'Cancelled') as cancelled_count,
  count(*) filter (order_status = 'Returned') as returned_count,
  count(*) filter (payment_method = '1-URGENT') as upi_count,
  count(*) filter (payment_method in ('2-HIGH', '3-MEDIUM')) as card_count,
  count(*) filter (payment_method = '5-LOW') as cod_count
from {source} group by 1, 2, 3"""


def _quality(source: str, as_of: str) -> str:
    return f"""figures as (
  select cast(count(*) filter (order_id is null) as double) as null_order_ids,
    cast(count(*) filter (final_amount < 0) as double) as negative_amounts,
    cast(count(*) filter (order_timestamp > {as_of} + interval 1 day) as double) as future_orders,
    coalesce(round(count(*) filter (cast(order_timestamp as date) = cast({as_of} as date)
                                    and order_status = 'Cancelled') * 100.0
             / nullif(count(*) filter (cast(order_timestamp as date) = cast({as_of} as date)), 0), 2), 0)
      as cancellation_rate, cast(count(*) as double) as orders
  from {source})
select 'null_order_ids' as "check", null_order_ids as observed, 0.0::double as threshold,
  null_order_ids = 0 as passed from figures
union all select 'negative_amounts', negative_amounts, 0.0, negative_amounts = 0 from figures
union all select 'future_orders', future_orders, 0.0, future_orders = 0 from figures
union all select 'cancellation_rate', cancellation_rate, 40.0, cancellation_rate <= 40 from figures
union all select 'table_not_empty', orders, 1.0, orders > 0 from figures"""


_EVENT_ORDERS = """e as (
  select cast(event_id as varchar) as order_id, ts as order_timestamp, cast(value as decimal(12,2)) as final_amount,
    case when event_type = 'error' then 'Cancelled' else 'Placed' end as order_status from events)"""
_COPIES = f"""lines as (
  select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as order_id, *,
    row_number() over (partition by l_orderkey, l_linenumber order by {ARRIVAL}) as copy from lineitem)"""
_LINE = "order_id, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice"
_PAYMENTS = """select payment_method, count(*) as order_count,
  cast(round(count(*) * 100.0 / sum(count(*)) over (), 2) as double) as percentage from f group by payment_method"""
_RECENT = "from f order by order_timestamp desc, order_id, final_amount, category limit"


def _short(value: str, steps: list[tuple[int, str]], small: str, sign: str = "") -> str:
    cases = " ".join(f"when {value} >= {step} then format('{{:.1f}}', cast({value} as double) / {step}) || '{suffix}'"
                     for step, suffix in steps)
    return f"'{sign}' || case {cases} else {small} end"


def _currency(value: str) -> str:
    return _short(value, [(10000000, "Cr"), (100000, "L"), (1000, "K")],
                  f"format('{{:.0f}}', cast({value} as double))", "₹")


def _number(value: str) -> str:
    return _short(value, [(100000, "L"), (1000, "K")], f"cast({value} as varchar)")


_MONTHS_AS_OF = "timestamp '1998-06-15 00:00:00'"


def _format_counts() -> list[str]:
    """A row for each malformed identifier and each text that is too wide."""
    uuid = "'[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}'"
    tables = {
        "orders": ("f", ("order_id", "customer_id", "product_id", "store_id"), {
            "customer_city": ("customer_city", 50), "customer_region": ("customer_region", 20),
            "customer_gender": ("s_name", 10), "product_name": ("product_name", 200), "category": ("category", 50),
            "brand": ("brand", 100), "store_type": ("s_name", 20), "store_city": ("store_city", 50),
            "store_region": ("store_region", 20), "payment_method": ("payment_method", 30),
            "order_status": ("order_status", 20), "device_type": ("brand", 20), "source": ("category", 30)}),
        "products": ("product_master", ("product_id",), {
            "name": ("name", 200), "category": ("category", 50), "brand": ("brand", 100)}),
        "stores": ("store_master", ("store_id",), {
            "store_name": ("store_name", 150), "city": ("city", 50), "region": ("region", 20),
            "store_type": ("store_type", 20)}),
    }
    found = []
    for table, (source, ids, widths) in tables.items():
        found += [f"select '{table}' as table_name, 'malformed_{x}' as reason from {source} "
                  f"where not regexp_full_match(cast({x} as varchar), {uuid})" for x in ids]
        found += [f"select '{table}', 'long_{x}' from {source} where length({of}) > {most}"
                  for x, (of, most) in widths.items() if (table, x) != ("products", "brand")]
    return found


ORACLES: dict[str, str] = {
    "kpi_totals": f"""with {FACTS}
select count(*) as total_orders, coalesce(cast(sum(final_amount) as double), 0) as total_revenue,
  coalesce(cast(sum(final_amount) as double) / count(*), 0) as avg_order_value,
  count(distinct customer_id) as unique_customers from f where {REVENUE}""",
    "revenue_by_category": f"""with {FACTS}
select category, count(*) as total_orders, cast(sum(final_amount) as double) as total_revenue,
  {MEAN} as avg_order_value, cast(sum(quantity) as bigint) as total_items_sold
from f where order_timestamp >= {AS_OF} - interval 30 days and {REVENUE} group by category""",
    "revenue_by_region": f"""with {FACTS}
select customer_region as region, count(*) as total_orders, cast(sum(final_amount) as double) as total_revenue,
  count(distinct customer_id) as unique_customers
from f where order_timestamp >= {AS_OF} - interval 30 days group by customer_region""",
    "daily_revenue_trend": f"""with {FACTS}
select cast(order_timestamp as date) as order_date, count(*) as total_orders,
  cast(sum(final_amount) as double) as daily_revenue, {MEAN} as avg_order_value
from f where order_timestamp >= {AS_OF} - interval 14 days group by 1""",
    "top_products": f"""with {FACTS}
select product_name, category, brand, count(*) as times_ordered, cast(sum(quantity) as bigint) as total_qty_sold,
  cast(sum(final_amount) as double) as total_revenue
from f where {REVENUE} group by 1, 2, 3
order by sum(final_amount) desc, product_name, category, brand limit 10""",
    "payment_distribution": f"with {FACTS} {_PAYMENTS}",
    "payment_display": f"""with {FACTS}, p as ({_PAYMENTS})
select payment_method as "Method", order_count as "Orders", percentage as "Share %" from p""",
    "hourly_orders": f"""with {_EVENT_ORDERS}
select cast(hour(order_timestamp) as bigint) as hour, count(*) as order_count,
  cast(sum(final_amount) as double) as revenue
from e where cast(order_timestamp as date) = date '2024-01-30' group by 1""",
    "daily_summary": f"with {FACTS} {_summary('f')}",
    "daily_summary_upsert": f"with {FACTS}, j as (select * replace (july_time as order_timestamp) from f) {_summary('j')}",
    "daily_summary_check": f"""with {FACTS}, s as ({_summary('f')})
select count(*) as categories, cast(coalesce(sum(total_orders), 0) as bigint) as total_orders,
  cast(coalesce(sum(cast(total_revenue as decimal(15,2))), 0) as double) as total_revenue
from s where summary_date = date '2001-08-01'""",
    "recent_orders": f"""with {FACTS}
select order_id, order_timestamp, customer_city, category, cast(final_amount as double) as final_amount,
  payment_method, order_status {_RECENT} 20""",
    "recent_orders_display": f"""with {FACTS}
select order_id[1:8] || '...' as "Order ID", strftime(order_timestamp, '%d %b %H:%M') as "Time",
  customer_city as "City", category as "Category",
  '₹' || format('{{:,.2f}}', cast(final_amount as double)) as "Amount", payment_method as "Payment",
  order_status as "Status" {_RECENT} 15""",
    "display_formats": f"""with o as (select *, cast(o_totalprice as decimal(12,2)) as amount_ from orders)
select o_orderkey, {_currency("amount_ / 100.0")} as small, {_currency("amount_")} as middle,
  {_currency("amount_ * 1000")} as large, {_number("o_orderkey")} as number,
  {_number("o_orderkey * 50")} as large_number,
  '₹' || format('{{:,.2f}}', cast(amount_ as double)) as amount, strftime(o_orderdate, '%d %b %H:%M') as time,
  ('order-' || cast(o_orderkey as varchar))[1:8] || '...' as id, o_orderpriority[1:5] as label from o""",
    "adhoc_sql": f"""with {FACTS}
select order_status, count(*) as orders, cast(sum(final_amount) as double) as revenue
from f where payment_method = '1-URGENT' group by order_status""",
    "row_counts": " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from {name}"
        for name in ("customer", "part", "supplier", "orders", "lineitem")),
    "dq_report": f"with {FACTS}, {_quality('f', AS_OF)}",
    "dq_report_events": f"with {_EVENT_ORDERS}, {_quality('e', chr(39).join(['timestamp ', '2024-01-28 18:00:00', '']))}",
    "dedup_keep_first": f"with {_COPIES} select {_LINE} from lines where copy = 1",
    "dedup_rejects": f"with {_COPIES} select {_LINE} from lines where copy > 1",
    "repeated_order_ids": f"""with {_COPIES}
select order_id, count(*) as copies from lines group by order_id having count(*) > 1""",
    "clean_valid": f"{_clean(_RULES)} select {_ORDER_COLUMNS} from tagged where reject_reasons = ''",
    "clean_rejects": f"{_clean(_RULES)} select {_REJECT_COLUMNS} from tagged where reject_reasons <> ''",
    "order_violations": f"""{_clean(_RULES + _TABLE_RULES)}
select {_REJECT_COLUMNS} from tagged where reject_reasons <> ''""",
    "sink_projection": f"""with {FACTS}
select order_id, cast(null as timestamp) as order_timestamp, cast(null as timestamp) as event_timestamp,
  cast(customer_id as varchar) as customer_id, cast(null as varchar) as product_id,
  cast(null as varchar) as store_id, cast(null as varchar) as customer_city,
  cast(null as varchar) as customer_region, cast(null as bigint) as customer_age,
  cast(null as varchar) as customer_gender, cast(null as varchar) as product_name,
  cast(null as varchar) as category, cast(null as varchar) as brand, cast(null as varchar) as store_type,
  cast(null as varchar) as store_city, cast(null as varchar) as store_region, cast(quantity as bigint) as quantity,
  cast(null as double) as unit_price, cast(null as double) as total_amount, cast(null as double) as tax_amount,
  cast(final_amount as double) as final_amount, cast(null as varchar) as payment_method, order_status,
  false as is_first_order, cast(null as varchar) as device_type, cast(null as varchar) as source from f""",
    "constraint_violations": f"""with {MASTERS}
select 'customers' as table_name, customer_id as row_key, reasons as reject_reasons from customer_tags
where reasons <> ''
union all select 'products', product_id, reasons from product_tags where reasons <> ''
union all select 'stores', store_id, reasons from store_tags where reasons <> ''""",
    "format_violations": f"""with {MASTERS}, v as (
  select 'malformed_customer_id' as reason from customer_master
  where not regexp_full_match(customer_id, '[0-9a-fA-F]{{8}}-([0-9a-fA-F]{{4}}-){{3}}[0-9a-fA-F]{{12}}')
  union all select 'long_name' from customer_master where length(name) > 100
  union all select 'long_email' from customer_master where length(email) > 150
  union all select 'long_phone' from customer_master where length(name) > 20
  union all select 'long_city' from customer_master where length(city) > 50
  union all select 'long_state' from customer_master where length(city || region) > 50
  union all select 'long_region' from customer_master where length(region) > 20
  union all select 'long_gender' from customer_master where length(gender) > 10)
select reason, count(*) as rows from v group by reason""",
    "duplicate_emails": f"with {MASTERS} select customer_id, email from customer_tags where repeated",
    "orphan_orders": f"""with {FACTS}, {MASTERS}, o as (
  select order_id, cast(customer_id as varchar) as customer_id, cast(product_id as varchar) as product_id,
    cast(store_id as varchar) as store_id, cast(final_amount as double) as final_amount from f),
tagged as (select *, {_list(_LINKS)} as reject_reasons from o)
select * from tagged where reject_reasons <> ''""",
    "column_defaults": """select cast(p_partkey as varchar) as product_id,
  cast(case when p_size * 2 > 50 then p_size * 2 else 0 end as bigint) as stock_quantity,
  timestamp '2001-08-01 00:00:00' as created_at, timestamp '2001-08-01 00:00:00' as updated_at from part""",
    "insert_if_absent_rows": f"""with {_COPIES}
select {_LINE} from lines where copy = 1
  and order_id not in (select order_id from lines where l_shipdate < timestamp '1998-01-01')""",
    "master_load": f"""with {MASTERS}
select customer_id, name, email, city, region, case when region = 'ASIA' then null else 'second' end as state,
  cast(age as bigint) as age from customer_master""",
    "denormalize_orders": f"""with {FACTS}, {MASTERS}
select f.order_id, f.order_timestamp, c.customer_id, p.product_id, s.store_id,
  cast(f.quantity as bigint) as quantity, cast(f.final_amount as double) as final_amount, c.name as customer_name,
  c.city as customer_city, c.region as customer_region, cast(c.age as bigint) as customer_age,
  c.gender as customer_gender, p.name as product_name, p.category, p.brand,
  cast(cast(format('{{:.2f}}', cast(p.original_price as double) * (1 - p.discount_pct / 100.0::double))
            as decimal(12,2)) as double) as unit_price,
  s.store_name, s.store_type, s.city as store_city, s.region as store_region
from f join customer_master c on cast(f.customer_id as varchar) = c.customer_id
join product_master p on cast(f.product_id as varchar) = p.product_id
join store_master s on cast(f.store_id as varchar) = s.store_id""",
    "region_lookup": f"""with {MASTERS}
select customer_id, city, case when region = 'EUROPE' then 'Central' else region end as region
from customer_master""",
    "price_orders": f"""with {FACTS}, p as (select *, unit_price * quantity as total from f),
q as (select *, cast(format('{{:.2f}}', cast(total as double) * 0.18::double) as decimal(12,2)) as tax from p)
select order_id, product_id, store_id, cast(unit_price as double) as unit_price, cast(quantity as bigint) as quantity,
  event_timestamp, cast(total as double) as total_amount, cast(tax as double) as tax_amount,
  cast(total + tax as double) as final_amount from q""",
    "discount_price": f"""with {MASTERS}
select product_id, cast(original_price as double) as original_price, cast(discount_pct as bigint) as discount_pct,
  cast(cast(format('{{:.2f}}', cast(original_price as double) * (1 - discount_pct / 100.0::double))
       as decimal(12,2)) as double) as discounted_price from product_master""",
    "json_decode": """select event_id, cast(json_extract(props, '$.k') as bigint) as k,
  cast(null as varchar) as payload from events""",
    "event_publish_rows": f"""with {FACTS}
select order_id as key, '{{"order_id":"' || order_id || '","order_timestamp":"' || strftime(order_timestamp,
  '%Y-%m-%d %H:%M:%S') || '","customer_id":' || cast(customer_id as varchar) || ',"quantity":'
  || cast(quantity as varchar) || ',"final_amount":' || cast(final_amount as varchar) || ',"order_status":"'
  || order_status || '","is_first_order":' || cast(is_first_order as varchar) || '}}' as value from f""",
    "stream_ingest": f"{STREAM} select {_ORDER_COLUMNS}, cast(order_timestamp as date) as order_date from stored",
    "stream_rejects": f"""{STREAM}
select case when cut then null else order_id end as order_id,
  case when cut then null else customer_id end as customer_id,
  case when cut then null else product_id end as product_id, case when cut then null else store_id end as store_id,
  case when cut then null else raw_quantity end as quantity,
  case when cut then null else raw_amount end as final_amount,
  case when cut then null else raw_category end as category,
  split_part(reject_reasons, ',', 1) as reject_reason, reject_reasons
from tagged where reject_reasons <> ''""",
    "stream_rejects_folded": f"""{STREAM}
select case when cut then null else order_id end as order_id,
  case when cut then null else customer_id end as customer_id,
  case when cut then null else product_id end as product_id, case when cut then null else store_id end as store_id,
  case when cut then null else raw_quantity end as quantity,
  case when cut then null else raw_amount end as final_amount,
  case when cut then null else raw_category end as category,
  split_part(reject_reasons, ',', 1) as reject_reason, reject_reasons
from tagged where reject_reasons <> ''""",
    "batch_metrics": f"""{STREAM}
select (select count(*) from tagged) as consumed, (select count(*) from stored) as inserted,
  (select count(*) from tagged where reject_reasons <> '') as invalid, cast(0 as bigint) as failed,
  (select count(*) from stored) * 100.0::double / (select count(*) from tagged) as success_rate""",
    "stream_replay": f"""{STREAM}
select count(*) as rows_before, count(*) as rows_after from stored""",
    "hourly_job": f"{STREAM} {_summary('stored')}",
    "daily_summary_merged": f"{MONTHS} {_summary('stored')}",
    "stream_ingest_open": f"{MONTHS} select {_ORDER_COLUMNS}, cast(order_timestamp as date) as order_date from stored",
    "stream_bounded": f"{STREAM} select {_ORDER_COLUMNS}, cast(order_timestamp as date) as order_date from stored",
    "order_key_index": f"{MONTHS} select order_id from stored",
    "stored_revenue_by_category": f"""{MONTHS}
select category, count(*) as total_orders, cast(sum(final_amount) as double) as total_revenue,
  {MEAN} as avg_order_value, cast(sum(quantity) as bigint) as total_items_sold
from stored where order_timestamp >= {_MONTHS_AS_OF} - interval 30 days and {REVENUE} group by category""",
    "stored_revenue_by_region": f"""{MONTHS}
select customer_region as region, count(*) as total_orders, cast(sum(final_amount) as double) as total_revenue,
  count(distinct customer_id) as unique_customers
from stored where order_timestamp >= {_MONTHS_AS_OF} - interval 30 days group by customer_region""",
    "stored_daily_trend": f"""{MONTHS}
select cast(order_timestamp as date) as order_date, count(*) as total_orders,
  cast(sum(final_amount) as double) as daily_revenue, {MEAN} as avg_order_value
from stored where order_timestamp >= {_MONTHS_AS_OF} - interval 14 days group by 1""",
    "stored_recent_orders": f"""{MONTHS}
select order_id, order_timestamp, customer_city, category, cast(final_amount as double) as final_amount,
  payment_method, order_status from stored order by order_timestamp desc, order_id, final_amount, category limit 20""",
    "stored_hourly_orders": f"""{MONTHS}
select cast(hour(order_timestamp) as bigint) as hour, count(*) as order_count,
  cast(sum(final_amount) as double) as revenue
from stored where cast(order_timestamp as date) = date '1998-06-01' group by 1""",
    "stored_dq_report": f"{MONTHS}, {_quality('stored', _MONTHS_AS_OF)}",
    "stored_day_summary": f"""{MONTHS},
days as (select * from stored where cast(order_timestamp as date) in (date '1998-06-01', date '1998-06-02'))
{_summary('days')}""",
    "stored_summary_check": f"""{MONTHS}, s as ({_summary('stored')})
select count(*) as categories, cast(coalesce(sum(total_orders), 0) as bigint) as total_orders,
  cast(coalesce(sum(cast(total_revenue as decimal(15,2))), 0) as double) as total_revenue
from s where summary_date = date '1998-06-01'""",
    "master_loads": f"""with {MASTERS},
one as (select *, email is not null and row_number() over (partition by email order by arrival) > 1 as taken
        from customer_tags where region = 'ASIA' and reasons = ''),
two as (select * exclude (repeated), email in (select email from one where not taken) as held
        from customer_tags where reasons = '' and customer_id not in (select customer_id from one where not taken)),
later as (select *, email is not null and (coalesce(held, false) or row_number() over (
            partition by email, coalesce(held, false) order by arrival) > 1) as taken from two)
select 'customers' as table_name, customer_id as row_key, 'first' as load_label, reasons as reject_reasons
from customer_tags where region = 'ASIA' and reasons <> ''
union all select 'customers', customer_id, 'first', 'duplicate_email' from one where taken
union all select 'customers', customer_id, 'second', reasons from customer_tags where reasons <> ''
union all select 'customers', customer_id, 'second', 'duplicate_email' from later where taken
union all select 'customers', customer_id, 'stored', '' from one where not taken
union all select 'customers', customer_id, 'stored', '' from later where not taken
union all select 'products', product_id, 'products', reasons from product_tags where reasons <> ''
union all select 'products', product_id, 'stored', '' from products
union all select 'stores', store_id, 'stores', reasons from store_tags where reasons <> ''
union all select 'stores', store_id, 'stored', '' from stores""",
    "format_violations_all": f"""with {FACTS}, {MASTERS}, v as (
  {" union all ".join(_format_counts())})
select table_name, reason, count(*) as rows from v group by table_name, reason""",
}
