"""Equivalent SQL for the correctness check, written for DuckDB.

Each query is one statement over the driver's tables (region, nation,
customer, supplier, part, orders, lineitem). Shared steps are written once
as named CTEs; ``statement`` prefixes a final SELECT with the CTEs it needs,
in dependency order. Nothing here is imported from the Spark package: rules,
declared tests and the dataset graph are written down again.
"""

from __future__ import annotations

import re

_CATEGORY = (
    "cast(case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 when 'MEDIUM' then 3 "
    "when 'PROMO' then 4 when 'SMALL' then 5 when 'STANDARD' then 6 end as bigint)"
)
# Line revenue: exact product of quantity, price and rate, rounded once.
def _revenue(prefix: str = "") -> str:
    q, p, d = (prefix + c for c in ("quantity", "list_price", "discount"))
    return (f"cast(round(cast(cast({q} as decimal(20,0)) * {p} as decimal(38,6)) "
            f"* cast(cast(1 as decimal(1,0)) - {d} as decimal(20,8)), 2) as decimal(18,2))")


_SURROGATE_NULL = "'_dbt_utils_surrogate_key_null_'"


def _skey(*cols: str) -> str:
    parts = [f"coalesce(cast({c} as varchar), {_SURROGATE_NULL})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def _label(col: str) -> str:
    return (
        f"case {col} when 1 then 'Pending' when 2 then 'Processing' "
        f"when 3 then 'Rejected' when 4 then 'Completed' else 'Unknown' end"
    )


CTES: dict[str, str] = {}

# --- raw tables, from the driver's tables -------------------------------------
CTES["raw_brands"] = """
select distinct cast(substr(p_brand, 7) as bigint) as brand_id, p_brand as brand_name
from part"""
CTES["raw_categories"] = f"""
select distinct {_CATEGORY} as category_id, p_type as category_name from part"""
CTES["raw_products"] = f"""
select p_partkey as product_id, p_name as product_name,
       cast(substr(p_brand, 7) as bigint) as brand_id, {_CATEGORY} as category_id,
       cast(2016 + p_size % 4 as bigint) as model_year,
       cast(p_retailprice as decimal(16,6)) as list_price
from part"""
CTES["raw_stores"] = """
select cast(n_nationkey as bigint) as store_id, n_name as store_name,
       case when n_nationkey % 4 = 0 then 'NULL'
            else '555-' || cast(n_nationkey as varchar) end as phone,
       case when n_nationkey % 5 = 0 then 'NULL'
            else 'store' || cast(n_nationkey as varchar) || '@example.com' end as email,
       'Street ' || cast(n_nationkey as varchar) as street,
       n_name as city, r_name as state, cast(10000 + n_nationkey as bigint) as zip_code
from nation join region on n_regionkey = r_regionkey"""
CTES["raw_staffs"] = """
select s_suppkey as staff_id, 'Supplier' as first_name, substr(s_name, 10) as last_name,
       case when s_suppkey % 5 = 0 then 'NULL'
            else 'staff' || cast(s_suppkey as varchar) || '@example.com' end as email,
       case when s_suppkey % 4 = 0 then 'NULL'
            else '555-' || cast(s_suppkey as varchar) end as phone,
       cast(case when s_suppkey % 7 = 0 then 0 else 1 end as bigint) as active,
       cast(s_nationkey as bigint) as store_id,
       case when s_suppkey < 3 then 'NULL' else cast(s_suppkey % 3 as varchar) end as manager_id
from supplier"""
CTES["raw_customers"] = """
select c_custkey as customer_id, 'Customer' as first_name, substr(c_name, 10) as last_name,
       case when c_custkey % 3 = 0 then 'NULL'
            else '555-' || cast(c_custkey as varchar) end as phone,
       case when c_custkey % 4 = 0 then 'NULL'
            else 'customer' || cast(c_custkey as varchar) || '@example.com' end as email,
       'Street ' || cast(c_custkey as varchar) as street,
       n_name as city, r_name as state, cast(20000 + c_nationkey as bigint) as zip_code
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
CTES["raw_order_items"] = """
select l_orderkey as order_id,
       cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey,
            l_suppkey, l_extendedprice, l_discount, l_quantity, l_shipdate) as bigint) as item_id,
       l_partkey as product_id, cast(l_quantity as bigint) as quantity,
       cast(l_extendedprice as decimal(16,6)) as list_price,
       cast(l_discount as decimal(9,8)) as discount
from lineitem"""
CTES["order_line_summary"] = """
select l_orderkey as order_key, max(l_shipdate) as last_ship, min(l_suppkey) as first_supplier
from lineitem group by l_orderkey"""
CTES["raw_orders"] = """
select o_orderkey as order_id, o_custkey as customer_id,
       cast(case o_orderstatus when 'O' then 1 when 'P' then 2 when 'F' then 4 end as bigint)
           as order_status,
       cast(cast(o_orderdate as date) as varchar) as order_date,
       cast(cast(o_orderdate as date) + cast(1 + o_orderkey % 5 as integer) as varchar)
           as required_date,
       case when o_orderstatus = 'P' or last_ship is null then 'NULL'
            else cast(cast(last_ship as date) as varchar) end as shipped_date,
       cast(s_nationkey as bigint) as store_id, first_supplier as staff_id
from orders
left join order_line_summary on o_orderkey = order_key
left join supplier on s_suppkey = first_supplier"""
CTES["raw_stocks"] = """
select store_id, product_id, (store_id * 7 + product_id) % 13 as quantity
from (select distinct cast(s_nationkey as bigint) as store_id, l_partkey as product_id
      from lineitem join supplier on l_suppkey = s_suppkey) pairs"""

# --- staging ------------------------------------------------------------------
CTES["stg_brands"] = """
select cast(brand_id as bigint) as brand_id, brand_name from raw_brands"""
CTES["stg_categories"] = """
select cast(category_id as bigint) as category_id, category_name from raw_categories"""
CTES["stg_customers"] = """
select cast(customer_id as bigint) as customer_id, first_name, last_name,
       nullif(phone, 'NULL') as phone, nullif(email, 'NULL') as email,
       street, city, state, cast(zip_code as bigint) as zip_code
from raw_customers"""
CTES["stg_order_items"] = """
select cast(order_id as bigint) as order_id, cast(item_id as bigint) as item_id,
       cast(product_id as bigint) as product_id, cast(quantity as bigint) as quantity,
       cast(list_price as decimal(16,6)) as list_price, cast(discount as decimal(9,8)) as discount
from raw_order_items"""
CTES["stg_orders"] = """
select cast(order_id as bigint) as order_id, cast(customer_id as bigint) as customer_id,
       cast(order_status as bigint) as order_status,
       try_cast(order_date as date) as order_date,
       try_cast(required_date as date) as required_date,
       try_cast(shipped_date as date) as shipped_date,
       cast(store_id as bigint) as store_id, cast(staff_id as bigint) as staff_id
from raw_orders"""
CTES["stg_products"] = """
select cast(product_id as bigint) as product_id, product_name,
       cast(brand_id as bigint) as brand_id, cast(category_id as bigint) as category_id,
       cast(model_year as bigint) as model_year, cast(list_price as decimal(16,6)) as list_price
from raw_products"""
CTES["stg_staffs"] = """
select cast(staff_id as bigint) as staff_id, first_name, last_name,
       nullif(email, 'NULL') as email, nullif(phone, 'NULL') as phone,
       cast(active as bigint) = 1 as active, cast(store_id as bigint) as store_id,
       try_cast(nullif(manager_id, 'NULL') as bigint) as manager_id
from raw_staffs"""
CTES["stg_stocks"] = """
select cast(store_id as bigint) as store_id, cast(product_id as bigint) as product_id,
       cast(quantity as bigint) as quantity
from raw_stocks"""
CTES["stg_stores"] = """
select cast(store_id as bigint) as store_id, store_name,
       nullif(phone, 'NULL') as phone, nullif(email, 'NULL') as email,
       street, city, state, cast(zip_code as bigint) as zip_code
from raw_stores"""

# --- intermediate, dimensions, facts -----------------------------------------
CTES["order_lines"] = f"""
select *, {_revenue()} as revenue
from stg_order_items"""
CTES["int_order_items_enriched"] = f"""
select oi.order_id, oi.item_id, oi.product_id, p.brand_id, p.category_id,
       p.product_name, p.model_year, b.brand_name, c.category_name,
       oi.quantity, oi.list_price, oi.discount,
       {_revenue('oi.')} as revenue
from stg_order_items oi
left join stg_products p on oi.product_id = p.product_id
left join stg_brands b on p.brand_id = b.brand_id
left join stg_categories c on p.category_id = c.category_id"""
CTES["dim_customers"] = """
select customer_id, first_name, last_name, first_name || ' ' || last_name as full_name,
       email, phone, street, city, state, zip_code
from stg_customers"""
CTES["dim_stores"] = """
select store_id, store_name, phone, email, street, city, state, zip_code from stg_stores"""
CTES["dim_products"] = """
select p.product_id, p.product_name, p.model_year, p.list_price,
       p.brand_id, b.brand_name, p.category_id, c.category_name
from stg_products p
left join stg_brands b on p.brand_id = b.brand_id
left join stg_categories c on p.category_id = c.category_id"""
CTES["dim_staffs"] = """
select s.staff_id, s.first_name, s.last_name, s.first_name || ' ' || s.last_name as full_name,
       s.email, s.phone, s.active, s.store_id, s.manager_id,
       m.first_name || ' ' || m.last_name as manager_name
from stg_staffs s left join stg_staffs m on s.manager_id = m.staff_id"""
def _calendar_cols(d: str) -> str:
    return f"""cast(year({d}) as bigint) as year,
       cast(quarter({d}) as bigint) as quarter,
       cast(month({d}) as bigint) as month,
       strftime({d}, '%B') as month_name,
       cast(day({d}) as bigint) as day_of_month,
       cast(dayofweek({d}) + 1 as bigint) as day_of_week,
       strftime({d}, '%A') as day_name,
       cast(strftime({d}, '%U') as bigint) as week_of_year,
       strftime({d}, '%Y-%m') as year_month,
       dayofweek({d}) + 1 in (1, 7) as is_weekend"""


def _spine(first_day: str, last_day: str) -> str:
    return (f"select cast(d as date) as date_day from generate_series("
            f"date '{first_day}', date '{last_day}', interval 1 day) t(d)")


CTES["dim_date"] = f"""
select date_day, {_calendar_cols('date_day')}
from ({_spine('1995-01-01', '2001-12-31')}) spine"""
CTES["default_calendar"] = f"""
select date_day, {_calendar_cols('date_day')}
from ({_spine('2016-01-01', '2019-12-31')}) spine"""
CTES["fct_order_items"] = f"""
select {_skey('ol.order_id', 'ol.item_id')} as order_item_key,
       ol.order_id, ol.item_id, ol.product_id, o.customer_id, o.store_id, o.staff_id,
       o.order_date, o.order_status, ol.quantity, ol.list_price, ol.discount, ol.revenue
from order_lines ol left join stg_orders o on ol.order_id = o.order_id"""
CTES["lines_per_order"] = """
select order_id, cast(count(*) as bigint) as n_items,
       cast(sum(quantity) as bigint) as total_quantity,
       cast(sum(revenue) as decimal(38,2)) as total_revenue
from order_lines group by order_id"""
CTES["fct_orders"] = f"""
select o.order_id, o.customer_id, o.store_id, o.staff_id, o.order_date, o.order_status,
       {_label('o.order_status')} as order_status_label,
       o.required_date, o.shipped_date,
       cast(datediff('day', o.order_date, o.required_date) as bigint) as days_to_required,
       cast(datediff('day', o.order_date, o.shipped_date) as bigint) as shipping_days,
       o.shipped_date is null as is_not_shipped,
       coalesce(o.shipped_date > o.required_date, false) as is_late,
       coalesce(a.n_items, 0) as n_items,
       coalesce(a.total_quantity, 0) as total_quantity,
       coalesce(a.total_revenue, cast(0 as decimal(38,2))) as total_revenue
from stg_orders o left join lines_per_order a on o.order_id = a.order_id"""
CTES["fct_stocks"] = f"""
select {_skey('s.store_id', 's.product_id')} as stock_key,
       s.store_id, s.product_id, s.quantity,
       cast(round(cast(s.quantity as decimal(20,0)) * p.list_price, 2) as decimal(18,2)) as stock_value,
       s.quantity = 0 as is_out_of_stock
from stg_stocks s left join stg_products p on s.product_id = p.product_id"""

# --- reporting ----------------------------------------------------------------
CTES["rpt_sales"] = f"""
select f.order_item_key, f.order_id, f.item_id, f.order_date,
       d.year as order_year, d.quarter as order_quarter, d.month as order_month,
       d.month_name as order_month_name, d.year_month as order_year_month,
       d.day_name as order_day_name, d.is_weekend as order_is_weekend,
       f.order_status, {_label('f.order_status')} as order_status_label,
       f.product_id, p.product_name, p.brand_name, p.category_name, p.model_year,
       f.store_id, st.store_name, st.city as store_city, st.state as store_state,
       f.customer_id, c.full_name as customer_name, c.city as customer_city,
       c.state as customer_state,
       f.staff_id, sf.full_name as staff_name,
       f.quantity, f.list_price as unit_price, f.discount, f.revenue
from fct_order_items f
left join dim_products p on f.product_id = p.product_id
left join dim_stores st on f.store_id = st.store_id
left join dim_customers c on f.customer_id = c.customer_id
left join dim_staffs sf on f.staff_id = sf.staff_id
left join dim_date d on f.order_date = d.date_day"""
CTES["rpt_orders"] = """
select o.order_id, o.order_date, d.year as order_year, d.quarter as order_quarter,
       d.month as order_month, d.year_month as order_year_month,
       o.required_date, o.shipped_date, o.order_status, o.order_status_label,
       o.days_to_required, o.shipping_days, o.is_not_shipped, o.is_late,
       o.store_id, st.store_name, st.city as store_city, st.state as store_state,
       o.customer_id, c.full_name as customer_name, c.city as customer_city,
       c.state as customer_state,
       o.staff_id, sf.full_name as staff_name,
       o.n_items, o.total_quantity, o.total_revenue
from fct_orders o
left join dim_stores st on o.store_id = st.store_id
left join dim_customers c on o.customer_id = c.customer_id
left join dim_staffs sf on o.staff_id = sf.staff_id
left join dim_date d on o.order_date = d.date_day"""
CTES["rpt_stocks"] = """
select s.stock_key, s.store_id, st.store_name, st.city as store_city, st.state as store_state,
       s.product_id, p.product_name, p.brand_name, p.category_name, p.model_year, p.list_price,
       s.quantity, s.stock_value, s.is_out_of_stock
from fct_stocks s
left join dim_stores st on s.store_id = st.store_id
left join dim_products p on s.product_id = p.product_id"""

_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(_NAME.findall(sql)) if n in CTES]


def statement(final_select: str, materialized: bool = False) -> str:
    """``WITH`` the CTEs ``final_select`` refers to (transitively), then it.
    ``materialized`` asks DuckDB to compute each CTE once."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for dep in _deps(CTES[name]):
            if dep != name:
                visit(dep)
        order.append(name)

    for name in _deps(final_select):
        visit(name)
    if not order:
        return final_select.strip()
    how = "as materialized" if materialized else "as"
    with_clause = ",\n".join(f"{n} {how} ({CTES[n].strip()})" for n in order)
    return f"with {with_clause}\n{final_select.strip()}"


def dataset_sql(name: str) -> str:
    if name == "dim_date":
        return statement(f"""
            select date_day, {_calendar_cols('date_day')}
            from (select cast(unnest(generate_series(
                      date_trunc('year', min(order_date)),
                      date_trunc('year', max(order_date)) + interval 1 year - interval 1 day,
                      interval 1 day)) as date) as date_day
                  from stg_orders) spine""")
    return statement(f"select * from {name}")


def _top(per: str, keys: str, n: int = 10) -> str:
    order = f"revenue desc, {keys}"
    return statement(
        f"select *, cast(row_number() over (order by {order}) as bigint) as rank "
        f"from ({per}) per qualify rank <= {n}"
    )


def _ratio(num: str, den: str) -> str:
    return f"cast({num} as double) / cast(nullif({den}, 0) as double)"


_REV = "cast(sum(revenue) as decimal(38,2)) as revenue"
_QTY = "cast(sum(quantity) as bigint) as total_quantity"
_LINES = "cast(count(*) as bigint) as n_lines"
_ORDERS = "cast(count(distinct order_id) as bigint) as n_orders"

KPI_SQL: dict[str, str] = {
    "kpi_revenue_store_month": statement(f"""
        select store_id, store_name, order_year_month, {_REV}, {_QTY}, {_LINES}
        from rpt_sales group by store_id, store_name, order_year_month"""),
    "kpi_revenue_state": statement(f"""
        select store_state, {_REV}, {_ORDERS}, {_LINES}
        from rpt_sales group by store_state"""),
    "kpi_revenue_period": statement(f"""
        select order_year, order_quarter, order_month, {_REV}, {_ORDERS}, {_LINES}
        from rpt_sales group by order_year, order_quarter, order_month"""),
    "kpi_top_products": _top(
        f"select product_id, product_name, {_REV}, {_QTY} from rpt_sales "
        "group by product_id, product_name", "product_id"),
    "kpi_top_categories": _top(
        f"select category_name, {_REV}, {_QTY} from rpt_sales group by category_name",
        "category_name"),
    "kpi_top_brands": _top(
        f"select brand_name, {_REV}, {_QTY} from rpt_sales group by brand_name", "brand_name"),
    "kpi_customer_value": statement(f"""
        select customer_id, customer_name, n_orders, revenue,
               {_ratio('revenue', 'n_orders')} as avg_basket
        from (select customer_id, customer_name, {_ORDERS}, {_REV}
              from rpt_sales group by customer_id, customer_name) per"""),
    "kpi_top_customers": _top(
        f"select customer_id, customer_name, n_orders, revenue, "
        f"{_ratio('revenue', 'n_orders')} as avg_basket from "
        f"(select customer_id, customer_name, {_ORDERS}, {_REV} from rpt_sales "
        "group by customer_id, customer_name) per_customer", "customer_id"),
    "kpi_customer_geo": statement(f"""
        select customer_state, customer_city,
               cast(count(distinct customer_id) as bigint) as n_customers, {_ORDERS}, {_REV}
        from rpt_sales group by customer_state, customer_city"""),
    "kpi_sales_staff": statement(f"""
        select staff_id, staff_name, store_id, store_name, {_REV}, {_ORDERS}, {_LINES}, {_QTY}
        from rpt_sales group by staff_id, staff_name, store_id, store_name"""),
    "kpi_weekday": statement(f"""
        select order_is_weekend, order_day_name, {_REV}, {_ORDERS}, {_LINES}
        from rpt_sales group by order_is_weekend, order_day_name"""),
    "kpi_late_rate": statement(f"""
        select store_id, store_name, n_orders, n_late, {_ratio('n_late', 'n_orders')} as late_rate
        from (select store_id, store_name, cast(count(*) as bigint) as n_orders,
                     cast(sum(cast(is_late as integer)) as bigint) as n_late
              from rpt_orders group by store_id, store_name) per"""),
    "kpi_shipping_delay": statement(f"""
        select store_id, store_name, n_shipped,
               {_ratio('sum_shipping_days', 'n_shipped')} as avg_shipping_days,
               min_shipping_days, max_shipping_days,
               {_ratio('sum_days_to_required', 'n_required')} as avg_days_to_required
        from (select store_id, store_name,
                     cast(count(shipping_days) as bigint) as n_shipped,
                     cast(sum(shipping_days) as bigint) as sum_shipping_days,
                     min(shipping_days) as min_shipping_days,
                     max(shipping_days) as max_shipping_days,
                     cast(count(days_to_required) as bigint) as n_required,
                     cast(sum(days_to_required) as bigint) as sum_days_to_required
              from rpt_orders group by store_id, store_name) per"""),
    "kpi_status_mix": statement(f"""
        select order_status, order_status_label, n_orders,
               {_ratio('n_orders', 'sum(n_orders) over ()')} as share
        from (select order_status, order_status_label, cast(count(*) as bigint) as n_orders
              from rpt_orders group by order_status, order_status_label) per"""),
    "kpi_revenue_per_order": statement(f"""
        select order_year_month, n_orders, total_revenue,
               {_ratio('total_revenue', 'n_orders')} as avg_revenue_per_order
        from (select order_year_month, cast(count(*) as bigint) as n_orders,
                     cast(sum(total_revenue) as decimal(38,2)) as total_revenue
              from rpt_orders group by order_year_month) per"""),
    "kpi_backlog": statement("""
        select store_id, store_name, cast(count(*) as bigint) as n_orders,
               cast(sum(cast(is_not_shipped as integer)) as bigint) as n_not_shipped,
               cast(coalesce(sum(case when is_not_shipped then total_revenue end), 0)
                    as decimal(38,2)) as backlog_revenue
        from rpt_orders group by store_id, store_name"""),
    "kpi_stock_store": statement("""
        select store_id, store_name, cast(count(*) as bigint) as n_products,
               cast(sum(quantity) as bigint) as total_quantity,
               cast(sum(stock_value) as decimal(38,2)) as stock_value
        from rpt_stocks group by store_id, store_name"""),
    "kpi_stockouts": statement(f"""
        select store_id, store_name, n_products, n_out_of_stock,
               {_ratio('n_out_of_stock', 'n_products')} as stockout_rate
        from (select store_id, store_name, cast(count(*) as bigint) as n_products,
                     cast(sum(cast(is_out_of_stock as integer)) as bigint) as n_out_of_stock
              from rpt_stocks group by store_id, store_name) per"""),
    "kpi_stockout_list": statement("""
        select store_id, store_name, store_state, product_id, product_name,
               brand_name, category_name
        from rpt_stocks where is_out_of_stock"""),
    "kpi_turnover": statement(f"""
        select s.store_id, s.product_id, coalesce(sold.units_sold, 0) as units_sold,
               s.quantity as units_in_stock,
               {_ratio('coalesce(sold.units_sold, 0)', 's.quantity')} as turnover
        from rpt_stocks s
        left join (select store_id, product_id, cast(sum(quantity) as bigint) as units_sold
                   from rpt_sales group by store_id, product_id) sold
          on s.store_id = sold.store_id and s.product_id = sold.product_id"""),
    "kpi_revenue_store_month_filtered": statement(f"""
        select store_id, store_name, order_year_month, {_REV}, {_QTY}, {_LINES}
        from rpt_sales where store_state = 'EUROPE'
        group by store_id, store_name, order_year_month"""),
    "kpi_revenue_state_of_brands": statement(f"""
        select store_state, {_REV}, {_ORDERS}, {_LINES}
        from rpt_sales where brand_name in ('Brand#11', 'Brand#22') group by store_state"""),
    "kpi_stock_store_out_of_stock": statement("""
        select store_id, store_name, cast(count(*) as bigint) as n_products,
               cast(sum(quantity) as bigint) as total_quantity,
               cast(sum(stock_value) as decimal(38,2)) as stock_value
        from rpt_stocks where is_out_of_stock group by store_id, store_name"""),
}

DATASET_NAMES = (
    "stg_brands", "stg_categories", "stg_customers", "stg_order_items", "stg_orders",
    "stg_products", "stg_staffs", "stg_stocks", "stg_stores", "int_order_items_enriched",
    "dim_customers", "dim_stores", "dim_products", "dim_staffs", "dim_date",
    "fct_order_items", "fct_orders", "fct_stocks", "rpt_sales", "rpt_orders", "rpt_stocks",
)


def all_sql() -> dict[str, str]:
    out = {name: dataset_sql(name) for name in DATASET_NAMES}
    out.update(KPI_SQL)
    return out


# --- ingestion and reconciliation ---------------------------------------------------

_TABLES = ("customers", "orders", "order_items", "staffs", "stores", "categories",
           "products", "stocks", "brands")
# Fixed values that results depend on: load-strategy labels per raw table.
_STRATEGY = {
    "customers": "merge (upsert on customer_id)",
    "orders": "merge (upsert on order_id)",
    "order_items": "merge (upsert on order_id, item_id)",
    "staffs": "replace (full refresh)",
    "stores": "replace (full refresh)",
    "categories": "replace (full refresh)",
    "products": "replace (full refresh)",
    "stocks": "replace (full refresh)",
    "brands": "replace (full refresh)",
}
_COUNTS = " union all ".join(
    f"select 'public_{t}' as table_name, count(*) as n from raw_{t}" for t in _TABLES
)
_LABELS = " union all ".join(
    f"select 'public_{t}' as table_name, '{label}' as load_strategy"
    for t, label in _STRATEGY.items()
)
_CHANGED = ("(try_cast(order_date as date) > date '1997-12-02' "
            "or try_cast(shipped_date as date) > date '1997-12-02')")

LOAD_SQL: dict[str, str] = {
    "load_replace": statement("select * from raw_stocks"),
    "load_merge_single_pk": statement("select * from raw_orders"),
    "load_merge_composite_pk": statement("select * from raw_order_items"),
    "load_merge_stream": statement("select * from raw_orders"),
    "load_lineage": statement("""
        select *, 'load-0001' as _load_id,
               sha256(concat_ws('|', coalesce(cast(store_id as varchar), ''),
                      coalesce(cast(product_id as varchar), ''), 'load-0001')) as _row_id
        from raw_stocks"""),
    "load_schema_evolution": statement(f"""
        select order_id, customer_id, order_status, order_date,
               case when {_CHANGED} then required_date end as required_date,
               shipped_date, store_id, staff_id
        from raw_orders"""),
    "recon_source_counts": statement(f"select * from ({_COUNTS}) c"),
    "load_log": statement(f"""
        select 'load-0001' as load_id, c.table_name,
               case when l.load_strategy like 'merge%' then 'merge' else 'replace' end
                   as load_mode,
               c.n as emitted_rows
        from ({_COUNTS}) c join ({_LABELS}) l on c.table_name = l.table_name"""),
    "load_selected": statement(f"""
        select c.table_name, replace(c.table_name, 'public_', '') as source_table,
               case when l.load_strategy like 'merge%' then 'merge' else 'replace' end
                   as load_mode,
               c.n as emitted_rows
        from ({_COUNTS}) c join ({_LABELS}) l on c.table_name = l.table_name
        where c.table_name in ('public_orders', 'public_stocks')"""),
    "load_merge_null_key": statement("""
        select distinct case when quantity > 0 then store_id end as store_id, product_id,
               case when quantity > 0 then quantity else 0 end as quantity
        from raw_stocks"""),
    "load_merge_touched_buckets": statement("select *, true as carried from raw_orders"),
    "load_merge_conflict": statement("select *, cast(1 as bigint) as refused from raw_orders"),
    "load_replayed": statement(f"""
        select c.table_name, 'load-0001' as load_id, cast(1 as bigint) as log_rows,
               c.n as emitted_rows, cast(1 as bigint) as versions
        from ({_COUNTS}) c"""),
    "load_schema_widened": statement("""
        select order_id,
               case when order_id % 3 = 0 then customer_id + 10000000000 else customer_id end
                   as customer_id,
               case when order_id % 3 = 1 then null else order_status end as order_status,
               case when order_id % 3 = 1 then 'S' || order_status end as order_status__string
        from raw_orders"""),
    "store_expired": statement("""
        select cast(v.k as bigint) as version, v.kept,
               case when v.kept then (select count(*) from raw_customers) end as n_rows,
               case when v.kept then (select count(*) from raw_customers
                   where customer_id % 97 between 1 and v.k) end as changed
        from (values (0, false), (1, true), (2, false), (3, true)) v(k, kept)"""),
    "load_merge_late_rows": statement("""
        select order_id, customer_id, order_status,
               cast(2 as integer) as _seq,
               (select count(*) from raw_orders) as first_emitted,
               2 * (select count(*) from raw_orders) as late_emitted
        from raw_orders"""),
    "recon_checks_diverged": statement(f"""
        select p.table_name, check_name, reference_rows, emitted_rows,
               reference_rows - emitted_rows as delta,
               coalesce(reference_rows = emitted_rows, false) as passed,
               'WARN' as severity, l.load_strategy
        from (select c.table_name, k.check_name,
                     case when k.check_name like 'source%' then
                         case when c.table_name = 'public_customers' then v.at_source else c.n end
                     when c.table_name = 'public_customers' then v.stored end as reference_rows,
                     case when c.table_name = 'public_customers' then v.emitted end
                         as emitted_rows
              from ({_COUNTS}) c
              cross join (select 'source_row_count_matches_load' as check_name
                          union all select 'stored_row_count_matches_load') k
              cross join (select count(*) as stored,
                                 count(*) filter (where state <> 'EUROPE') as at_source,
                                 count(*) + count(*) filter (where state = 'ASIA') as emitted
                          from raw_customers) v) p
        join ({_LABELS}) l on p.table_name = l.table_name"""),
    "recon_checks": statement(f"""
        select c.table_name, k.check_name, c.n as reference_rows, c.n as emitted_rows,
               cast(0 as bigint) as delta, true as passed, 'WARN' as severity, l.load_strategy
        from ({_COUNTS}) c
        join ({_LABELS}) l on c.table_name = l.table_name
        cross join (select 'source_row_count_matches_load' as check_name
                    union all select 'stored_row_count_matches_load') k"""),
}

# --- data quality -------------------------------------------------------------------

DQ_SQL: dict[str, str] = {
    "dq_unique": statement("""
        select order_id, count(*) as n_records from stg_order_items
        where order_id is not null group by order_id having count(*) > 1"""),
    "dq_not_null": statement("select * from fct_orders where shipped_date is null"),
    "dq_relationships": statement("""
        select order_date, count(*) as n_records from fct_order_items f
        where order_date is not null
          and not exists (select 1 from default_calendar d where d.date_day = f.order_date)
        group by order_date"""),
    "dq_accepted_values": statement("""
        select order_status, count(*) as n_records from fct_orders
        where order_status is not null and order_status not in (1, 2)
        group by order_status"""),
    "dq_accepted_range": statement("""
        select * from fct_orders where shipping_days is not null and not (shipping_days >= 0)"""),
    "dq_unique_combination": statement("""
        select l_orderkey, l_linenumber, count(*) as n_records from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1"""),
    # Straight from the source tables: a line's last ship date before the order's day.
    "dq_shipped_after_order": """
        select o_orderkey as order_id, cast(o_orderdate as date) as order_date,
               cast(max(l_shipdate) as date) as shipped_date
        from orders join lineitem on l_orderkey = o_orderkey
        where o_orderstatus is distinct from 'P'
        group by o_orderkey, o_orderdate
        having cast(max(l_shipdate) as date) < cast(o_orderdate as date)""",
    # Lines of 45 or more pieces are billed 1.00 too much.
    "dq_revenue_reconciliation": statement("""
        select order_id, total_revenue,
               cast(total_revenue + n_over as decimal(38,2)) as revenue_from_lines
        from fct_orders
        join (select l_orderkey, count(*) filter (where l_quantity >= 45) as n_over
              from lineitem group by l_orderkey) over_billed on l_orderkey = order_id
        where n_over > 0"""),
    "dq_revenue_formula": statement("""
        select order_id, item_id, cast(revenue + 1 as decimal(18,2)) as revenue,
               revenue as expected_revenue
        from order_lines where quantity >= 45"""),
}


# The declared tests. A line per dataset and kind: nn not null,
# u unique and not null, uq unique, uc unique combination, in accepted values,
# fk column>dataset.column, rng column[bounds] with ( ) open and [ ] closed ends.
_DECLARED = """
stg_customers u customer_id
stg_orders u order_id
stg_orders fk customer_id>stg_customers.customer_id store_id>stg_stores.store_id staff_id>stg_staffs.staff_id
stg_orders nn order_status order_date
stg_orders in order_status
stg_order_items uc order_id,item_id
stg_order_items nn order_id item_id product_id quantity
stg_order_items fk order_id>stg_orders.order_id product_id>stg_products.product_id
stg_order_items rng quantity(0, list_price[0, discount[0,1]
stg_staffs u staff_id
stg_staffs fk store_id>stg_stores.store_id manager_id>stg_staffs.staff_id
stg_stores u store_id
stg_categories u category_id
stg_categories nn category_name
stg_products u product_id
stg_products fk brand_id>stg_brands.brand_id category_id>stg_categories.category_id
stg_products rng list_price[0,
stg_stocks uc store_id,product_id
stg_stocks nn store_id product_id
stg_stocks fk store_id>stg_stores.store_id product_id>stg_products.product_id
stg_stocks rng quantity[0,
stg_brands u brand_id
stg_brands nn brand_name
int_order_items_enriched uc order_id,item_id
int_order_items_enriched nn order_id item_id product_id quantity revenue
int_order_items_enriched fk product_id>stg_products.product_id
int_order_items_enriched rng quantity(0, list_price[0, discount[0,1] revenue[0,
dim_products u product_id
dim_stores u store_id
dim_customers u customer_id
dim_staffs u staff_id
dim_staffs fk store_id>dim_stores.store_id
dim_date u date_day
fct_order_items uc order_id,item_id
fct_order_items u order_item_key
fct_order_items nn order_id item_id product_id quantity revenue
fct_order_items fk product_id>dim_products.product_id customer_id>dim_customers.customer_id store_id>dim_stores.store_id staff_id>dim_staffs.staff_id order_date>dim_date.date_day
fct_order_items rng quantity(0, discount[0,1] revenue[0,
fct_orders u order_id
fct_orders fk customer_id>dim_customers.customer_id store_id>dim_stores.store_id
fct_orders in order_status
fct_orders rng total_revenue[0,
fct_stocks uc store_id,product_id
fct_stocks u stock_key
fct_stocks nn store_id product_id
fct_stocks fk store_id>dim_stores.store_id product_id>dim_products.product_id
fct_stocks rng quantity[0,
rpt_sales uc order_id,item_id
rpt_sales u order_item_key
rpt_sales nn order_id item_id product_id quantity revenue
rpt_sales rng quantity(0, discount[0,1] revenue[0,
rpt_orders u order_id
rpt_orders rng total_revenue[0,
rpt_stocks uc store_id,product_id
rpt_stocks u stock_key
rpt_stocks nn store_id product_id
rpt_stocks rng quantity[0,
"""


def _one_test(ds: str, kind: str, spec: str) -> list[tuple[str, str, str, str]]:
    """(dataset, kind, columns, violation count) of the tests one entry stands for."""
    if kind == "nn":
        return [(ds, "not_null", spec, f"select count(*) from {ds} where {spec} is null")]
    if kind == "u":
        twice = (f"select count(*) from (select 1 from {ds} where {spec} is not null "
                 f"group by {spec} having count(*) > 1) v")
        return [(ds, "unique", spec, twice), *_one_test(ds, "nn", spec)]
    if kind == "uc":
        return [(ds, "unique_combination", spec,
                 f"select count(*) from (select 1 from {ds} group by {spec} having count(*) > 1) v")]
    if kind == "in":
        return [(ds, "accepted_values", spec,
                 f"select count(distinct {spec}) from {ds} where {spec} not in (1, 2, 3, 4)")]
    if kind == "fk":
        col, to = spec.split(">")
        parent, field = to.split(".")
        return [(ds, "relationships", col,
                 f"select count(*) from {ds} c where c.{col} is not null and not exists "
                 f"(select 1 from {parent} p where p.{field} = c.{col})")]
    strict = "(" in spec
    col, bounds = re.split(r"[(\[]", spec)
    low, high = bounds.rstrip(")]").split(",")
    bad = f"{col} {'<=' if strict else '<'} {low}" + (f" or {col} > {high}" if high else "")
    return [(ds, "accepted_range", col, f"select count(*) from {ds} where {bad}")]


_GENERIC = [t for line in _DECLARED.strip().split("\n")
            for ds, kind, *specs in [line.split()] for spec in specs
            for t in _one_test(ds, kind, spec)]
# Business tests: the datasets they read, and their violation count.
_BUSINESS = {
    "assert_shipped_after_order_date": (("fct_orders",), f"""
        select count(*) from ({DQ_SQL['dq_shipped_after_order']}) v"""),
    "assert_order_revenue_reconciliation": (("fct_orders", "fct_order_items"), """
        select count(*) from fct_orders o
        join (select order_id, sum(revenue) as r from fct_order_items group by order_id) l
          on o.order_id = l.order_id
        where abs(o.total_revenue - l.r) > 0.01"""),
    "assert_revenue_formula": (("fct_order_items",), """
        select count(*) from fct_order_items f join order_lines l
          on f.order_id = l.order_id and f.item_id = l.item_id
        where f.revenue <> l.revenue"""),
}


def _test_rows(shared: bool = False) -> list[str]:
    """One SELECT per test: dataset, test_name, test_type, column_name,
    severity, n_violations. ``shared`` lists a business test under every
    dataset that it reads, else under the first."""
    rows = [
        f"select '{ds}' as dataset, '{kind}_{ds}_{cols.replace(',', '_')}' as test_name, "
        f"'{kind}' as test_type, '{cols}' as column_name, 'error' as severity, "
        f"cast(({count}) as bigint) as n_violations"
        for ds, kind, cols, count in _GENERIC
    ]
    for name, (inputs, count) in _BUSINESS.items():
        rows += [
            f"select '{ds}' as dataset, '{name}' as test_name, 'singular' as test_type, "
            f"cast(null as varchar) as column_name, 'error' as severity, "
            f"cast(({count.strip()}) as bigint) as n_violations"
            for ds in (inputs if shared else inputs[:1])
        ]
    return rows


def dq_report_sql() -> str:
    body = "\nunion all\n".join(_test_rows())
    # Each dataset is read by many tests: have DuckDB compute it once.
    return statement(f"select *, n_violations = 0 as passed from ({body}) tests", True)


def dq_report_singular_sql() -> str:
    body = "\nunion all\n".join(r for r in _test_rows() if "'singular'" in r)
    return statement(f"select *, n_violations = 0 as passed from ({body}) tests", True)


# --- scalar functions -----------------------------------------------------------------

SCALAR_SQL: dict[str, str] = {
    "scalar_staging_casts": statement("""
        select cast(staff_id as bigint) as staff_id, email as email_text,
               nullif(email, 'NULL') as email, active as active_code,
               cast(active as bigint) = 1 as active, manager_id as manager_text,
               try_cast(nullif(manager_id, 'NULL') as bigint) as manager_id
        from raw_staffs"""),
    "scalar_surrogate_key": statement(f"""
        select order_id, {_skey('order_id')} as order_key,
               {_skey('order_id', 'shipped_date')} as shipment_key
        from stg_orders"""),
    "scalar_status_label": statement(f"""
        select order_id, order_status, {_label('order_status')} as order_status_label
        from stg_orders"""),
    "scalar_delivery_delays": statement("""
        select order_id,
               cast(datediff('day', order_date, required_date) as bigint) as days_to_required,
               cast(datediff('day', order_date, shipped_date) as bigint) as shipping_days,
               shipped_date is null as is_not_shipped,
               coalesce(shipped_date > required_date, false) as is_late
        from stg_orders"""),
    "scalar_calendar": statement(f"""
        select order_id, order_date as date_day, {_calendar_cols('order_date')}
        from stg_orders"""),
    "scalar_revenue_exact": """
        select l_orderkey as order_id, l_linenumber as line_number,
               cast(round(cast(cast(cast(l_quantity as bigint) as decimal(20,0))
                               * cast(price as decimal(16,6)) as decimal(38,6))
                          * cast(cast(1 as decimal(1,0)) - cast(rate as decimal(9,8))
                                 as decimal(20,8)), 2)
                    as decimal(18,2)) as revenue
        from (select *, cast(cast(floor(l_extendedprice) as bigint) as varchar) || '.'
                        || lpad(cast(l_partkey * 7 % 1000 as varchar), 3, '0') as price,
                     '0.' || lpad(cast(l_suppkey * 7919 % 100000 as varchar), 5, '0') as rate
              from lineitem) priced""",
    "scalar_revenue": statement("""
        select order_id, item_id, quantity, list_price, discount, revenue from order_lines"""),
}


# The dashboard's query, as registered.
DASHBOARD = """
select r.order_year_month, r.store_state, s.brand_name, s.order_status,
       cast(sum(s.revenue) as decimal(38,2)) as revenue,
       cast(count(distinct s.order_id) as bigint) as n_orders,
       cast(sum(case when r.is_late then 1 else 0 end) as bigint) as n_late_lines
from rpt_sales s
join rpt_orders r on s.order_id = r.order_id
group by r.order_year_month, r.store_state, s.brand_name, s.order_status"""

# The dataset graph: name, layer, table or view, what it reads.
_GRAPH = [
    *((f"stg_{t}", "staging", "view", ()) for t in _TABLES),
    ("order_lines", "intermediate", "view", ("stg_order_items",)),
    ("int_order_items_enriched", "intermediate", "view",
     ("order_lines", "stg_products", "stg_brands", "stg_categories")),
    ("dim_customers", "marts", "table", ("stg_customers",)),
    ("dim_stores", "marts", "table", ("stg_stores",)),
    ("dim_products", "marts", "table", ("stg_products", "stg_brands", "stg_categories")),
    ("dim_staffs", "marts", "table", ("stg_staffs",)),
    ("dim_date", "marts", "table", ()),
    ("fct_order_items", "marts", "table", ("order_lines", "stg_orders")),
    ("fct_orders", "marts", "table", ("stg_orders", "order_lines")),
    ("fct_stocks", "marts", "table", ("stg_stocks", "stg_products")),
    ("rpt_sales", "reporting", "table", ("fct_order_items", "dim_products", "dim_stores",
                                         "dim_customers", "dim_staffs", "dim_date")),
    ("rpt_orders", "reporting", "table", ("fct_orders", "dim_stores", "dim_customers",
                                          "dim_staffs", "dim_date")),
    ("rpt_stocks", "reporting", "table", ("fct_stocks", "dim_stores", "dim_products")),
]
_READS = {name: deps for name, _, _, deps in _GRAPH}


def _above(name: str) -> set[str]:
    return set(_READS[name]).union(*(_above(d) for d in _READS[name]))


def _meta(names: set[str] | None = None) -> str:
    return " union all ".join(
        f"select '{n}' as dataset, '{layer}' as layer, '{kind}' as materialized"
        for n, layer, kind, _ in _GRAPH if names is None or n in names)


def _row_counts(names: set[str] | None = None) -> str:
    return " union all ".join(
        f"select '{n}' as dataset, count(*) as n from {n}"
        for n, _, kind, _ in _GRAPH if kind == "table" and (names is None or n in names))


def build_report_sql() -> str:
    """The gated build's report: a dataset fails when one of the tests that
    read it finds violations, and is skipped (no tests, no rows) when an
    ancestor failed."""
    tests = "\nunion all\n".join(_test_rows(shared=True))
    graph = " union all ".join(f"select '{n}' as dataset, '{a}' as ancestor"
                               for n in _READS for a in sorted(_above(n)))
    final = f"""
        select m.dataset, m.layer, m.materialized,
               case when s.dataset is not null then 'skipped'
                    when coalesce(p.n_failed, 0) > 0 then 'failed' else 'success' end as status,
               cast(case when s.dataset is not null then 0 else coalesce(p.n_tests, 0) end
                    as bigint) as n_tests,
               cast(case when s.dataset is not null then 0 else coalesce(p.n_failed, 0) end
                    as bigint) as n_failed,
               case when s.dataset is null then c.n end as n_rows
        from ({_meta()}) m
        left join (select dataset, count(*) as n_tests,
                          count(*) filter (where n_violations > 0) as n_failed
                   from ({tests}) t group by dataset) p on m.dataset = p.dataset
        left join (select distinct g.dataset
                   from ({graph}) g
                   join (select dataset from ({tests}) t2 where n_violations > 0) f
                     on g.ancestor = f.dataset) s on m.dataset = s.dataset
        left join ({_row_counts()}) c on m.dataset = c.dataset"""
    return statement(final, True)


def _written_report(names: set[str], status: dict[str, str] | None = None,
                    tests: dict[str, tuple[int, int]] | None = None) -> str:
    """A report of datasets without generic tests: rows written, statuses given."""
    case = " ".join(f"when '{n}' then '{s}'" for n, s in (status or {}).items())
    gone = [n for n, s in (status or {}).items() if s in ("error", "skipped")]
    n_of = {k: " ".join(f"when '{n}' then {v[k]}" for n, v in (tests or {}).items()) for k in (0, 1)}
    pick = lambda text, other: f"case m.dataset {text} else {other} end" if text else other
    hidden = ", ".join(f"'{n}'" for n in gone) or "''"
    return statement(f"""
        select m.dataset, m.layer, m.materialized, {pick(case, "'success'")} as status,
               cast({pick(n_of[0], 0)} as bigint) as n_tests,
               cast({pick(n_of[1], 0)} as bigint) as n_failed,
               case when m.dataset not in ({hidden}) then c.n end as n_rows
        from ({_meta(names)}) m left join ({_row_counts(names)}) c on m.dataset = c.dataset""", True)


_MARTS = {"dim_customers", "dim_stores", "dim_products", "dim_staffs", "dim_date",
          "fct_order_items", "fct_orders", "fct_stocks"}
_REPORTS = {"rpt_sales", "rpt_orders", "rpt_stocks"}

BUILD_SQL: dict[str, str] = {
    "build_materialized": _written_report(set(_READS)),
    "build_selected": _written_report(_REPORTS | {"dim_stores"}),
    "build_report_error": _written_report(
        {"dim_customers", "dim_stores", "dim_products", "dim_staffs", "dim_date", "fct_orders",
         "fct_stocks", "rpt_orders", "rpt_stocks"},
        {"dim_customers": "error", "rpt_orders": "skipped"}),
    "gate_two_input_test": _written_report(
        _MARTS | _REPORTS,
        {"fct_orders": "failed", "fct_order_items": "failed", "rpt_sales": "skipped",
         "rpt_orders": "skipped"},
        {"fct_orders": (1, 1), "fct_order_items": (1, 1)}),
    "build_ci": statement("select *, 'retail_ci_marts' as layer_folder from dim_stores"),
}


def _answers(question: str, keys: str, measures: tuple[str, ...], top: bool = False) -> str:
    """One question straight from the lines, in the common columns of all questions."""
    by = keys.split(", ")
    key = " || '|' || ".join(f"coalesce(cast({k} as varchar), '')" for k in by)
    known = {"revenue": "cast(sum(revenue) as decimal(38,2))", "n_orders": "cast(count(distinct order_id) as bigint)",
             "n_lines": "cast(count(*) as bigint)", "total_quantity": "cast(sum(quantity) as bigint)",
             "n_customers": "cast(count(distinct customer_id) as bigint)",
             "avg_basket": "cast(sum(revenue) as double) / nullif(count(distinct order_id), 0)"}
    shown = ", ".join(f"{e if m in measures else 'null'} as {m}" for m, e in known.items())
    place = f"row_number() over (order by sum(revenue) desc, {by[0]})"
    rank = f"cast({place} as bigint)" if top else "cast(null as bigint)"
    return (f"select '{question}' as question, {key} as answer_key, {shown}, {rank} as rank "
            f"from rpt_sales group by {keys}" + (f" qualify {place} <= 10" if top else ""))


def kpi_from_rollup_sql() -> str:
    per_line, per_order = ("revenue", "n_lines", "total_quantity"), ("revenue", "n_orders", "n_lines")
    basket, product = ("revenue", "n_orders", "avg_basket"), ("revenue", "total_quantity")
    return statement(" union all ".join([
        _answers("kpi_revenue_store_month", "store_id, store_name, order_year_month", per_line),
        _answers("kpi_revenue_state", "store_state", per_order),
        _answers("kpi_revenue_period", "order_year, order_quarter, order_month", per_order),
        _answers("kpi_customer_value", "customer_id, customer_name", basket),
        _answers("kpi_top_customers", "customer_id, customer_name", basket, top=True),
        _answers("kpi_customer_geo", "customer_state, customer_city", ("revenue", "n_orders", "n_customers")),
        _answers("kpi_sales_staff", "staff_id, staff_name, store_id, store_name", per_order + ("total_quantity",)),
        _answers("kpi_weekday", "order_is_weekend, order_day_name", per_order),
        _answers("kpi_top_products", "product_id, product_name", product, top=True),
        _answers("kpi_top_categories", "category_name", product, top=True),
        _answers("kpi_top_brands", "brand_name", product, top=True),
    ]), True)


def all_sql_full() -> dict[str, str]:
    out = all_sql()
    out.update(LOAD_SQL)
    out.update(DQ_SQL)
    out.update(SCALAR_SQL)
    out.update(BUILD_SQL)
    out["kpi_from_rollup"] = kpi_from_rollup_sql()
    out["fct_orders_bucketed"] = dataset_sql("fct_orders")
    out["fct_order_items_bucketed"] = dataset_sql("fct_order_items")
    out["dq_report"] = dq_report_sql()
    out["dq_report_singular"] = dq_report_singular_sql()
    out["build_report"] = build_report_sql()
    out["sql_dashboard"] = statement(DASHBOARD, True)
    return out
