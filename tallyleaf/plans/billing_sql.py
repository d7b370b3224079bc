"""The billing queries once more, as ANSI SQL over the same tables."""

from tallyleaf.plans import billing
from tallyleaf.sources import tables

LINES = """
kept as (
  select * from (
    select *, row_number() over (partition by l_orderkey, l_linenumber
      order by l_shipdate desc, l_extendedprice desc, l_partkey desc, l_quantity desc, l_returnflag desc, l_tax desc
    ) as copy_rank from lineitem) where copy_rank = 1),
bills as (
  select o_orderkey,
    'S' || lpad(cast(o_orderkey % 25 as varchar), 2, '0') || '/' || strftime(o_orderdate, '%Y%m%d') || '/'
      || cast(o_orderkey as varchar) as bill_no,
    o_orderstatus = 'P' and o_orderpriority = '1-URGENT' as cancelled,
    case when o_orderpriority = '5-LOW'
      then -cast(cast(o_totalprice as decimal(18,2)) * cast(0.01 as decimal(2,2)) as decimal(18,2)) end as discount,
    o_orderpriority = '2-HIGH' as cash
  from orders),
items as (
  select bill_no, l_linenumber as line_no, 'P' || cast(l_partkey as varchar) as product_code,
    cast(case when l_returnflag = 'R' then -l_quantity else l_quantity end as decimal(10,2)) as qty,
    cast(l_extendedprice as decimal(18,2)) as unit_price,
    case when l_returnflag = 'R' then 'RETURN' else 'SALE' end as line_type,
    cast(l_tax as decimal(4,2)) as tax_rate, cancelled
  from kept join bills on l_orderkey = o_orderkey),
revenue_lines as (
  select bill_no, line_no, product_code, qty, unit_price, line_type, tax_rate from items
  union all
  select bill_no, line_no + 50, product_code, -qty, unit_price, 'VOID', tax_rate from items where cancelled
  union all
  select bill_no, 101, 'DISC', cast(1 as decimal(10,2)), discount, 'DISCOUNT', cast(0 as decimal(4,2))
  from bills where discount is not null),
"""

PARTS_OF_BILL = """
    split_part(bill_no, '/', 1) as store_id,
    cast(strptime(split_part(bill_no, '/', 2), '%Y%m%d') as date) as business_date,
    strftime(strptime(split_part(bill_no, '/', 2), '%Y%m%d'), '%Y-%m') as year_month,
    dayname(strptime(split_part(bill_no, '/', 2), '%Y%m%d')) as day_of_week
"""

FACT = f"""{LINES}
fact as (select *, qty * unit_price as line_revenue, {PARTS_OF_BILL} from revenue_lines)
"""

SALES = f"""{LINES}
summed as (
  select bill_no, cast(round(sum(qty * unit_price * tax_rate), 2) as decimal(18,2)) as tax,
    cast(sum(qty * unit_price) as decimal(18,2)) as net
  from revenue_lines group by bill_no),
all_lines as (
  select bill_no, line_no, product_code, qty, unit_price, line_type from revenue_lines
  union all select bill_no, 102, 'TAX', 1, tax, 'TAX' from summed
  union all
  select bill_no, 103, 'TENDER', 1,
    case when cash then cast(round(net + tax, 0) as decimal(18,2)) else cast(net + tax as decimal(18,2)) end, 'TENDER'
  from summed join (select bill_no, cash from bills) using (bill_no)),
sales as (
  select *, case when line_type in ('TAX', 'TENDER') then 0 else qty * unit_price end as line_revenue, {PARTS_OF_BILL}
  from all_lines)
"""

DIMS = f"""
stores as (
  select 'S' || lpad(cast(n_nationkey as varchar), 2, '0') as store_id, 'Store ' || n_name as store_name,
    n_name as city, r_name as region
  from nation join region on n_regionkey = r_regionkey),
products as (
  select 'P' || cast(p_partkey as varchar) as product_code, p_partkey * 2 as product_sk, p_name as product_name,
    p_type as category_id, date '1990-01-01' as valid_from,
    case when p_size = 7 then date '{tables.REISSUED_ON}' - 1 else date '{tables.LAST_DAY}' end as valid_to,
    case when p_size = 7 then 0 else 1 end as is_current
  from part
  union all
  select 'P' || cast(p_partkey as varchar), p_partkey * 2 + 1, 'reissued ' || p_name,
    case when p_type = 'PROMO' then 'LARGE' else 'PROMO' end, date '{tables.REISSUED_ON}', date '{tables.LAST_DAY}', 1
  from part where p_size = 7),
categories as (
  select distinct p_type as category_id, 'Category ' || p_type as category_name,
    case when p_type in ('PROMO', 'ECONOMY') then 'Value' else 'Core' end as department
  from part),
listed as (
  select product_sk, w.no as no, w.s as effective_from, w.e as effective_to,
    cast(cast(p_retailprice as decimal(12,2)) * w.f as decimal(12,2)) as selling_price
  from products join part on product_code = 'P' || cast(p_partkey as varchar),
    (values {", ".join(f"({i}, date '{s}', date '{e}', cast({f} as decimal(3,2)))"
                       for i, (s, e, f) in enumerate(tables.PRICE_WINDOWS))}) as w(no, s, e, f)),
prices as (
  select product_sk * 3 + no as revision_id, product_sk, selling_price, effective_from, effective_to,
    cast(selling_price * cast(1.10 as decimal(3,2)) as decimal(12,2)) as mrp
  from listed)
"""

MONTHLY = """
bill_totals as (
  select bill_no, year_month, sum(line_revenue) as bill_revenue, count(*) as line_count from fact group by all),
monthly as (
  select year_month, cast(round(sum(bill_revenue), 2) as decimal(18,2)) as revenue,
    cast(sum(round(bill_revenue, 0)) as decimal(18,2)) as rounded_revenue, count(*) as total_bills
  from bill_totals group by year_month)
"""


def money(total, places=2):
    return f"cast(round({total}, {places}) as double)"


REVENUE = money("sum(line_revenue)")
UNITS = money("sum(qty)", 0)
DATED = "product_code = p.product_code and business_date between valid_from and valid_to"
HASH = (
    "cast('0x' || substr(md5(concat_ws('|', bill_no, line_no, product_code, qty, unit_price, line_type)), 1, 15)"
    " as bigint)"
)

BY_STORE = f"""
  select f.store_id, store_name, city, region, {REVENUE} as total_revenue, count(distinct bill_no) as total_bills
  from fact f join stores s on f.store_id = s.store_id group by all"""
BY_CATEGORY = f"""
  select c.category_id, category_name, department, {REVENUE} as total_revenue, {UNITS} as units_sold
  from fact f join products p on f.{DATED} join categories c on p.category_id = c.category_id group by all"""
STORE_CATEGORIES = f"""
  select region, city, store_name, category_name, {REVENUE} as category_revenue, {UNITS} as units_sold
  from fact f join stores s on f.store_id = s.store_id join products p on f.{DATED}
    join categories c on p.category_id = c.category_id"""
PRICES = f"""
  select year_month, p.product_sk, p.product_code, product_name, category_name, revision_id,
    cast(mrp as double) as mrp, cast(selling_price as double) as effective_price,
    cast(effective_from as varchar) as effective_from, cast(effective_to as varchar) as effective_to,
    cast(sum(unit_price) as double) / count(*) as avg_printed_price, {UNITS} as total_units_sold,
    {money("sum(qty * selling_price)")} as revenue_at_list_price
  from fact f join products p on f.{DATED} join categories c on p.category_id = c.category_id
    join prices r on p.product_sk = r.product_sk and business_date between effective_from and effective_to"""


def _in(values):
    return ", ".join(f"'{v}'" for v in values)


ORACLE = {
    "revenue_by_month": f"""with {FACT}
select year_month, {REVENUE} as total_revenue, count(distinct bill_no) as total_bills,
  {REVENUE} / count(distinct bill_no) as avg_basket
from fact group by year_month""",
    "all_lines_round_trip": f"""with {SALES}
select store_id, year_month, line_type, count(*) as line_count, {money("sum(qty * unit_price)")} as subtotal
from sales group by store_id, year_month, line_type""",
    "layout_metrics": f"""with {FACT}
select count(distinct year_month) as flat_files, count(*) as flat_rows,
  count(distinct store_id) filter (store_id = 'S01' and year_month = '{billing.KPI_MONTH}') as pruned_files,
  count(*) filter (store_id = 'S01' and year_month = '{billing.KPI_MONTH}') as pruned_rows,
  count(distinct year_month) / greatest(
    count(distinct store_id) filter (store_id = 'S01' and year_month = '{billing.KPI_MONTH}'), 1) as file_reduction
from fact""",
    "line_type_audit": f"""with {SALES}
select year_month, line_type, count(*) as line_count, {money("sum(qty * unit_price)")} as subtotal,
  case when line_type in ('SALE', 'RETURN', 'DISCOUNT', 'VOID') then 'revenue'
    else 'not revenue' end as revenue_treatment
from sales group by year_month, line_type""",
    "double_count_audit": f"""with {SALES}
select year_month, {money("sum(qty * unit_price)")} as naive_total, {REVENUE} as true_revenue,
  case when {REVENUE} <> 0 then {money("sum(qty * unit_price)")} / {REVENUE} end as ratio
from sales group by year_month""",
    "ingest_metrics": """
select cast(count(*) as bigint) as raw_lines, count(distinct (l_orderkey, l_linenumber)) as unique_lines,
  cast(count(*) - count(distinct (l_orderkey, l_linenumber)) as bigint) as duplicates_removed
from lineitem""",
    "fact_summary": f"""with {FACT}
select count(*) as total_rows, {REVENUE} as total_revenue, count(distinct bill_no) as distinct_bills,
  bit_xor({HASH}) as digest_xor, cast(sum({HASH}) % 2147483647 as bigint) as digest_sum
from fact""",
    "idempotent_runs": f"""with {FACT}
select run, count(*) as rows, bit_xor({HASH}) as digest_xor, cast(sum({HASH}) % 2147483647 as bigint) as digest_sum
from fact, (values (1), (2)) as runs(run) group by run""",
    "bill_integrity": f"""with {SALES},
per_bill as (
  select bill_no, year_month,
    coalesce(sum(qty * unit_price) filter (line_type in ('SALE', 'RETURN', 'VOID')), 0) as items,
    coalesce(sum(qty * unit_price) filter (line_type = 'DISCOUNT'), 0) as discount,
    coalesce(sum(qty * unit_price) filter (line_type = 'TAX'), 0) as tax,
    coalesce(sum(qty * unit_price) filter (line_type = 'TENDER'), 0) as tender,
    count(*) filter (line_type = 'VOID') as voids
  from sales group by bill_no, year_month)
select year_month, count(*) as bills, count(*) filter (tender = items + discount + tax) as balanced_bills,
  count(*) filter (voids > 0) as void_bills,
  count(*) filter (voids > 0 and items + discount = 0) as void_bills_at_zero, {money("sum(tender)")} as tender_total
from per_bill group by year_month""",
    "store_month": f"""with {FACT}
select count(*) as line_count, {REVENUE} as revenue from fact
where store_id = 'S01' and year_month = '{billing.KPI_MONTH}'""",
    "revenue_by_store": f"with {FACT}, {DIMS} {BY_STORE}",
    "top_stores": f"""with {FACT}, {DIMS}, by_store as ({BY_STORE})
select store_id, store_name, city, region, total_revenue from by_store order by total_revenue desc, store_id limit 5""",
    "revenue_by_category": f"with {FACT}, {DIMS} {BY_CATEGORY}",
    "top_categories": f"""with {FACT}, {DIMS}, by_category as ({BY_CATEGORY})
select category_id, category_name, department, total_revenue from by_category
order by total_revenue desc, category_id limit 5""",
    "revenue_by_weekday": f"""with {FACT},
days as (select business_date, day_of_week, sum(line_revenue) as day_total from fact group by all)
select day_of_week, cast(isodow(business_date) as integer) as weekday_no, {money("sum(day_total)")} as total_revenue,
  {money("sum(day_total)", 4)} / count(*) as avg_daily_revenue
from days group by 1, 2""",
    "kpi": f"""with {FACT}
select {REVENUE} as total_revenue,
  {money(f"sum(case when year_month = '{billing.KPI_MONTH}' then line_revenue else 0 end)")} as month_revenue,
  count(distinct bill_no) as total_bills, count(distinct store_id) as total_stores
from fact""",
    "reissued_codes": f"""with {DIMS}
select product_code, product_sk, product_name, category_id, cast(valid_from as varchar) as valid_from,
  cast(valid_to as varchar) as valid_to, is_current
from products where product_code in (select product_code from products group by product_code having count(*) > 1)""",
    "reissued_code_sales": f"""with {FACT}, {DIMS}
select year_month, product_sk, p.product_code, product_name, category_name, {UNITS} as total_qty,
  {REVENUE} as total_revenue
from fact f join products p on f.{DATED} join categories c on p.category_id = c.category_id
where year_month in ({_in(billing.SWITCH_MONTHS)})
  and p.product_code in (select product_code from products group by product_code having count(*) > 1)
group by year_month, product_sk, p.product_code, product_name, category_name""",
    "code_join_fanout": f"""with {FACT}, {DIMS}
select count(*) as code_join_rows,
  count(*) filter (business_date between valid_from and valid_to) as dated_join_rows,
  count(*) - count(*) filter (business_date between valid_from and valid_to) as surplus_rows
from fact f join products p on f.product_code = p.product_code""",
    "effective_prices": f"with {FACT}, {DIMS} {PRICES} group by all",
    "price_comparison": f"""with {FACT}, {DIMS}, report as ({PRICES}
  where year_month in ({_in(billing.COMPARED_MONTHS)}) group by all)
select * exclude (product_sk, category_name) from report""",
    "price_mismatch": f"""with {FACT}, {DIMS},
dated as (
  select f.*, p.product_sk from fact f join products p on f.{DATED}),
printed as (
  select r.product_sk, effective_from, effective_to, unit_price as selling_price
  from prices r join dated d on d.product_sk = r.product_sk and business_date between effective_from and effective_to
  where line_type = 'SALE'
  qualify row_number() over (partition by revision_id order by business_date, bill_no, line_no) = 1),
lines as (
  select unit_price, selling_price from dated d
  left join printed r on d.product_sk = r.product_sk and business_date between effective_from and effective_to)
select count(*) as item_lines, count(selling_price) as priced_lines,
  count(*) filter (abs(unit_price - selling_price) > 0.001) as mismatched_lines,
  count(*) - count(selling_price) as unpriced_lines,
  count(*) filter (abs(unit_price - selling_price) > 0.001) / count(selling_price) as mismatch_rate
from lines""",
    "store_category_revenue": f"with {FACT}, {DIMS} {STORE_CATEGORIES} group by all",
    "top_store_categories": f"""with {FACT}, {DIMS} {STORE_CATEGORIES}
where year_month = '{billing.KPI_MONTH}' and region = '{billing.REPORT_REGION}' group by all
order by category_revenue desc, store_name, category_name limit 10""",
    "bill_rounding": f"""with {FACT}, {MONTHLY}
select year_month, cast(revenue as double) as revenue, cast(rounded_revenue as double) as rounded_revenue,
  cast(revenue - rounded_revenue as double) as rounding_difference, total_bills
from monthly""",
    "monthly_reconciliation": f"""with {FACT}, {MONTHLY},
sold as (
  select l_orderkey, sum(cast(case when l_returnflag = 'R' then -l_quantity else l_quantity end as decimal(10,2))
    * cast(l_extendedprice as decimal(18,2))) as sold from kept group by l_orderkey),
booked as (
  select strftime(o_orderdate, '%Y-%m') as month, coalesce(sold, 0) - case when o_orderpriority = '5-LOW'
    then cast(cast(o_totalprice as decimal(18,2)) * cast(0.01 as decimal(2,2)) as decimal(18,2)) else 0 end as amount
  from orders left join sold on o_orderkey = l_orderkey
  where not (o_orderstatus = 'P' and o_orderpriority = '1-URGENT') and (sold is not null or o_orderpriority = '5-LOW')),
booked_months as (
  select month, cast(round(sum(amount), 2) as decimal(18,2)) as revenue,
    cast(sum(round(amount, 0)) as decimal(18,2)) as rounded_revenue from booked group by month),
ledger as (
  select month, last_day(cast(month || '-01' as date)) + 9 as closed_on,
    case when month = '{tables.BULK_MONTH}' then revenue + cast({tables.BULK_INVOICE} as decimal(18,2))
      when month = '{tables.ROUNDED_MONTH}' then rounded_revenue else revenue end as revenue_inr
  from booked_months where month <> '{tables.UNSIGNED_MONTH}'
  union all select '{tables.EARLY_MONTH}', date '1995-01-09', 0),
compared as (
  select coalesce(m.year_month, l.month) as month, revenue, revenue_inr, closed_on,
    case when revenue is null then 'MISSING_PIPELINE' when revenue_inr is null then 'MISSING_LEDGER'
      when revenue = revenue_inr then 'MATCH' else 'DIFF' end as status
  from monthly m full outer join ledger l on m.year_month = l.month)
select month, cast(revenue as double) as pipeline_revenue, cast(revenue_inr as double) as ledger_revenue,
  cast(revenue - revenue_inr as double) as difference, status, cast(closed_on as varchar) as closed_on,
  case when status = 'MATCH' then 'Exact match' when status <> 'DIFF' then status
    when month = '{tables.BULK_MONTH}' then 'Scope: invoice outside the tills'
    when month = '{tables.ROUNDED_MONTH}' then 'Rounding: bill-level rounding' else 'Unclassified' end as root_cause
from compared""",
    "missing_store_days": f"""with {LINES}
days as (
  select distinct split_part(bill_no, '/', 1) as store_id,
    cast(strptime(split_part(bill_no, '/', 2), '%Y%m%d') as date) as business_date
  from bills),
span as (select store_id, min(business_date) as first, max(business_date) as last from days group by 1),
calendar as (
  select store_id, cast(unnest(generate_series(first, last, interval 1 day)) as date) as business_date from span)
select c.store_id, cast(c.business_date as varchar) as business_date
from calendar c anti join days d on c.store_id = d.store_id and c.business_date = d.business_date""",
    "partition_round_trip": f"""with {FACT}
select store_id, year_month, {REVENUE} as revenue, count(*) as line_count from fact group by all""",
}
