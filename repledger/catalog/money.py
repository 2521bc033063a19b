"""Queries: totals, shares, reports and periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from repledger.catalog.registry import query
from repledger.catalog.tables import Tables
from repledger.functions import dates
from repledger.operators import calc, match, report
from repledger.sources import ledger

AS_OF = dt.date(2001, 12, 31)

SHARED = """shares as (
 select *, cast(actual_comm_paid*cast(0.45 as decimal(4,2)) as decimal(18,4)) as sales_commission,
  case when cm_sales is null then 0 else coalesce(nullif(cm_split,0),20) end as points from lines)"""

MONTH_END = """rated as (
 select lines.*, c.sales_percentage as cm_pct, d.sales_percentage as design_pct,
  coalesce(nullif(cm_split,0),20) as split
 from lines left join salespeople c on c.sales_initials=cm_sales left join salespeople d on d.sales_initials=design_sales),
month_end as (
 select *, cast(case when cm_sales is not null and design_sales is not null
   then (cm_pct*cast(split as decimal(9,4))+design_pct*(cast(100 as decimal(9,4))-cast(split as decimal(9,4))))
        *cast(0.01 as decimal(3,2))
   else coalesce(nullif(cm_pct,0),nullif(design_pct,0)) end as decimal(10,6)) as rate from rated),
calculated as (
 select *, case when coalesce(cm_sales,'')='QQ' or coalesce(design_sales,'')='QQ'
     then cast(actual_comm_paid*cast(0.45 as decimal(4,2)) as decimal(18,4))
   when rate<>0 then cast(actual_comm_paid*rate*cast(0.01 as decimal(3,2)) as decimal(18,4)) end as sales_commission,
  case when coalesce(cm_sales,'')='QQ' or coalesce(design_sales,'')='QQ' or rate is not null then null
   when cm_sales is not null and design_sales is not null then 'NO_PERCENTAGE' else 'NO_SALESPERSON' end as rate_issue
 from month_end)"""

PERSON = MONTH_END + """,
fanned as (
 select cm_sales as salesperson, calculated.* from calculated where cm_sales is not null
 union all
 select design_sales, calculated.* from calculated
 where design_sales is not null and design_sales is distinct from cm_sales),
scaled0 as (
 select f.*, s.sales_percentage as pct,
  case when cm_sales is not null and design_sales is not null then
   cast(actual_comm_paid*cast(case when cm_sales=design_sales then 100 when cm_sales=f.salesperson then split
     else 100-split end as decimal(9,4))*cast(0.01 as decimal(3,2)) as decimal(18,4))
   else cast(actual_comm_paid as decimal(18,4)) end as paid
 from fanned f join salespeople s on s.sales_initials=f.salesperson),
scaled as (
 select *, case when cm_sales is not null and design_sales is not null
   then cast(paid*pct*cast(0.01 as decimal(3,2)) as decimal(18,4)) else sales_commission end as own from scaled0)"""

POOL = """pool as (
 select sales_initials as salesperson, cast((select cast(coalesce(sum(sales_commission),0) as decimal(20,4))
   from calculated where design_sales='QQ')*qq_split*cast(0.01 as decimal(3,2)) as decimal(18,4)) as own
 from salespeople where qq_split is not null)"""

REPORT_ROWS = PERSON + ",\n" + POOL + """,
report as (
 select salesperson, principal, paid_on_revenue, paid, own from scaled
 union all select salesperson, 'VARIOUS (MISC POOL)', null, null, own from pool)"""


def calculated(t: Tables):
    return calc.month_end_commission(t.lines, t.salespeople)


def per_person(t: Tables):
    return report.commission_report(calculated(t).drop("rate_issue"), t.salespeople, AS_OF)


@query("principal_totals", ("lines",), "with " + SHARED + """
select case when grouping(principal)=1 then 'Grand Total' else principal end as principal,
 cast(grouping(principal) as int) as level,
 cast(sum(paid_on_revenue) as decimal(18,2)) as paid_on_revenue,
 cast(sum(actual_comm_paid) as decimal(18,4)) as actual_comm_paid,
 cast(sum(sales_commission) as decimal(18,4)) as sales_commission,
 case when sum(actual_comm_paid)<>0 and sum(paid_on_revenue)<>0
  then cast(sum(actual_comm_paid) as double)/cast(sum(paid_on_revenue) as double) end as true_comm_pct
from shares group by rollup(principal)""")
def principal_totals(t: Tables):
    return report.principal_totals(calc.split_shares(t.lines), with_rate=True).orderBy("level", "principal")


@query("split_shares", ("lines",), "with " + SHARED + """,
cm as (select *, cast(sales_commission*cast(points as decimal(9,4))*cast(0.01 as decimal(3,2)) as decimal(18,4)) as c from shares)
select unique_id, cm_sales, sales_commission, c as cm_sales_comm,
 cast(sales_commission-c as decimal(18,4)) as design_sales_comm from cm""")
def split_shares(t: Tables):
    return calc.split_shares(t.lines).select("unique_id", "cm_sales", "sales_commission", "cm_sales_comm",
                                             "design_sales_comm")


@query("month_end_commission", ("lines", "salespeople"), "with " + MONTH_END + """
select unique_id, cm_sales, design_sales, sales_commission, rate_issue from calculated""")
def month_end_commission(t: Tables):
    return calculated(t).select("unique_id", "cm_sales", "design_sales", "sales_commission", "rate_issue")


@query("commission_report", ("lines", "salespeople"), "with " + PERSON + ",\n" + POOL + """
select salesperson, unique_id, principal, t_end_cust, design_sales, comm_month, paid as actual_comm_paid,
 own as sales_commission from scaled
union all select salesperson, null, 'VARIOUS (MISC POOL)', 'MISC POOL', 'QQ', date '2001-12-31', null, own from pool""")
def commission_report(t: Tables):
    return per_person(t).select("salesperson", "unique_id", "principal", "t_end_cust", "design_sales", "comm_month",
                                "actual_comm_paid", "sales_commission")


@query("salesperson_totals", ("lines", "salespeople"), "with " + REPORT_ROWS + """
select salesperson, principal, cast(grouping(principal) as int) as level,
 cast(sum(paid_on_revenue) as decimal(18,2)) as paid_on_revenue,
 cast(sum(paid) as decimal(18,4)) as actual_comm_paid, cast(sum(own) as decimal(18,4)) as sales_commission
from report group by grouping sets ((salesperson),(salesperson,principal))""")
def salesperson_totals(t: Tables):
    return report.totals_by_person(per_person(t))


@query("quarterly_report", ("lines", "salespeople"), "with " + PERSON + """
select salesperson, principal, cast(grouping(principal) as int) as level,
 cast(sum(paid) as decimal(18,4)) as actual_comm_paid, cast(sum(own) as decimal(18,4)) as sales_commission
from scaled where comm_month between date '2001-04-01' and date '2001-06-01'
group by grouping sets ((salesperson),(salesperson,principal))""")
def quarterly_report(t: Tables):
    quarter = report.quarter_to_date(calculated(t).drop("rate_issue"), F.lit(dt.date(2001, 6, 1)))
    return report.quarterly_salespeople(quarter, t.salespeople)


CDS = """accts as (select proper_name, count(*) as n, max(sls) as sls from accounts group by proper_name having count(*)=1),
tagged as (select lines.*, case when a.proper_name is not null then a.sls
   else coalesce(design_sales,cm_sales) end as cds
 from lines left join accts a on a.proper_name=t_end_cust)"""


@query("revenue_by_person", ("lines", "accounts", "salespeople"), "with " + CDS + """,
owners as (
 select cds as salesperson, tagged.* from tagged where cds is not null
 union all select cm_sales, tagged.* from tagged where cm_split<>20 and cm_sales is not null and cm_sales is distinct from cds)
select salesperson, unique_id, principal, t_end_cust, part_number, quarter_shipped, paid_on_revenue, cds
from owners where quarter_shipped is not null and salesperson in (select sales_initials from salespeople)""")
def revenue_by_person(t: Tables):
    return report.revenue_by_person(t.lines, t.accounts, t.salespeople).select(
        "salesperson", "unique_id", "principal", "t_end_cust", "part_number", "quarter_shipped", "paid_on_revenue", "cds")


PIVOT_QUARTERS = ("2000Q4", "2001Q1", "2001Q2", "2001Q3", "2001Q4")


def pivot_cells(col: str, values, value: str, to: str) -> str:
    return ",\n ".join(f"cast(sum(case when {col}='{v}' then {value} end) as {to}) as \"{v}\"" for v in values)


@query("revenue_pivot", ("lines", "accounts"), "with " + CDS + f"""
select t_end_cust, cm, part_number, {pivot_cells('quarter_shipped', PIVOT_QUARTERS, 'paid_on_revenue', 'decimal(18,2)')}
from tagged where quarter_shipped in ('2000Q4','2001Q1','2001Q2','2001Q3','2001Q4')
group by t_end_cust, cm, part_number""")
def revenue_pivot(t: Tables):
    quarters = report.newest_quarters(t.lines)
    lines = report.revenue_history(t.lines, quarters=quarters)
    return report.pivot_sum(lines, ["t_end_cust", "cm", "part_number"], "quarter_shipped", "paid_on_revenue",
                            values=report.headings(quarters), to="decimal(18,2)")


@query("revenue_pivot_by_person", ("lines", "accounts", "salespeople"), "with " + CDS + f""",
owners as (
 select cds as salesperson, tagged.* from tagged where cds is not null
 union all select cm_sales, tagged.* from tagged where cm_split<>20 and cm_sales is not null and cm_sales is distinct from cds)
select salesperson, principal, t_end_cust, part_number, cm,
 {pivot_cells('quarter_shipped', PIVOT_QUARTERS, 'paid_on_revenue', 'decimal(18,2)')}
from owners where quarter_shipped in ('2000Q4','2001Q1','2001Q2','2001Q3','2001Q4')
 and salesperson in (select sales_initials from salespeople)
group by salesperson, principal, t_end_cust, part_number, cm""")
def revenue_pivot_by_person(t: Tables):
    quarters = report.newest_quarters(t.lines)
    lines = report.revenue_by_person(report.revenue_history(t.lines, quarters=quarters), t.accounts, t.salespeople)
    return report.pivot_sum(lines, ["salesperson", "principal", "t_end_cust", "part_number", "cm"], "quarter_shipped",
                            "paid_on_revenue", to="decimal(18,2)", values=report.headings(quarters))


QUARTER_REPORT = """m as (select max(comm_month) as m from lines),
current as (select * from scaled, m where comm_month>=date_trunc('quarter', m) and comm_month<=m),
misc as (select sales_initials as salesperson, cast((select cast(coalesce(sum(sales_commission),0) as decimal(20,4))
   from calculated, m where design_sales='QQ' and comm_month>=date_trunc('quarter', m) and comm_month<=m)
   *qq_split*cast(0.01 as decimal(3,2)) as decimal(18,4)) as own from salespeople where qq_split is not null),
rows_of as (select salesperson, t_end_cust, principal, strftime(comm_month,'%Y-%m') as heading, own from current
 union all select salesperson, 'MISC POOL', 'VARIOUS (MISC POOL)', strftime(m,'%Y-%m'), own from misc, m)"""


@query("commission_pivot", ("lines", "salespeople"), "with " + PERSON + ",\n" + QUARTER_REPORT + """
select salesperson, t_end_cust, principal, heading, cast(grouping(t_end_cust)*2+grouping(principal) as int) as level,
 cast(grouping(heading) as int) as all_headings, cast(sum(own) as decimal(18,4)) as value
from rows_of group by grouping sets ((salesperson,t_end_cust,principal,heading),(salesperson,t_end_cust,principal),
 (salesperson,t_end_cust,heading),(salesperson,t_end_cust),(salesperson,heading),(salesperson))""")
def commission_pivot(t: Tables):
    month = report.latest_month(t.lines)
    quarter = report.quarter_to_date(calculated(t).drop("rate_issue"), month)
    return report.commission_pivot(report.commission_report(quarter, t.salespeople, month))


@query("overall_revenue_pivot", ("lines", "accounts"), "with " + CDS + """,
q as (select distinct quarter_shipped as q from lines order by 1 desc nulls last limit 5)
select principal, cds, t_end_cust, part_number, cm, coalesce(quarter_shipped,'(blank)') as heading,
 cast(sum(paid_on_revenue) as decimal(18,2)) as value
from tagged where coalesce(quarter_shipped,'') in (select coalesce(q,'') from q) group by all""")
def overall_revenue_pivot(t: Tables):
    kept = report.revenue_history(t.lines, quarters=report.newest_quarters(t.lines))
    return report.overall_revenue_pivot(match.tag_current_design_sales(kept, t.accounts))


@query("quarterly_principals", ("lines",), "with " + SHARED + """,
m as (select max(comm_month) as m from lines),
s as (select cast(date_trunc('quarter', m + interval 1 month) - interval 3 month as date) as s from m)
select case when grouping(principal)=1 then 'Grand Total' else principal end as principal,
 cast(grouping(principal) as int) as level,
 cast(sum(paid_on_revenue) as decimal(18,2)) as paid_on_revenue,
 cast(sum(actual_comm_paid) as decimal(18,4)) as actual_comm_paid,
 cast(sum(sales_commission) as decimal(18,4)) as sales_commission,
 case when sum(actual_comm_paid)<>0 and sum(paid_on_revenue)<>0
  then cast(sum(actual_comm_paid) as double)/cast(sum(paid_on_revenue) as double) end as true_comm_pct
from shares, s where comm_month>=s and comm_month<s + interval 3 month group by rollup(principal)""")
def quarterly_principals(t: Tables):
    return report.principal_totals(report.finished_quarter(calc.split_shares(t.lines)), with_rate=True)


@query("last_five_quarters", ("lines",), """
with q as (select distinct quarter_shipped from lines order by quarter_shipped desc nulls last limit 5)
select coalesce(lines.quarter_shipped,'') as quarter_shipped, count(*) as n_lines,
 cast(sum(paid_on_revenue) as decimal(18,2)) as paid_on_revenue
from lines where quarter_shipped in (select quarter_shipped from q) group by 1""")
def last_five_quarters(t: Tables):
    kept = report.revenue_history(t.lines)
    return kept.groupBy(F.coalesce("quarter_shipped", F.lit("")).alias("quarter_shipped")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("paid_on_revenue").cast("decimal(18,2)").alias("paid_on_revenue"))


@query("current_month_slice", ("lines",), """
select unique_id, comm_month, cast(comm_month + interval 1 month as date) as following_month, actual_comm_paid
from lines where comm_month=(select max(comm_month) from lines)""")
def current_month_slice(t: Tables):
    return report.latest_month_slice(t.lines).select(
        "unique_id", "comm_month", dates.next_month(F.col("comm_month")).alias("following_month"), "actual_comm_paid")


@query("file_totals", ("lines",), """
select from_file, sheet_name, cast(grouping(sheet_name) as int) as level, count(*) as n_lines,
 cast(sum(actual_comm_paid) as decimal(18,2)) as total_commissions
from lines group by grouping sets ((from_file,sheet_name),(from_file))""")
def file_totals(t: Tables):
    return report.file_totals(t.lines)


@query("ledger_append", ("lines",), """
select from_file as filename, cast(sum(actual_comm_paid) as decimal(18,2)) as total_commissions,
 date '2001-12-31' as date_added from lines where comm_month>=date '2001-01-01' group by from_file
union all
select from_file, case when from_file like '%1999' then cast(0 as decimal(18,2))
  else cast(sum(actual_comm_paid) as decimal(18,2)) end, date '2000-12-31'
from lines where comm_month<date '2001-01-01' group by from_file""")
def ledger_append(t: Tables):
    cut = F.lit(dt.date(2001, 1, 1))
    old = ledger.file_entries(t.lines.filter(F.col("comm_month") < cut), dt.date(2000, 12, 31))
    old = old.withColumn("total_commissions", F.when(F.endswith("filename", F.lit("1999")), F.lit("n/a"))
                         .otherwise(F.col("total_commissions").cast("string")))
    new = ledger.file_entries(t.lines.filter(F.col("comm_month") >= cut), AS_OF)
    return ledger.append_entries(old, new).drop("paid_date")


@query("dedupe_files", ("lines",), """
with known as (select distinct from_file from lines where comm_month<date '1999-01-01' and quantity>=25)
select from_file, count(*) as n_lines, cast(sum(actual_comm_paid) as decimal(18,2)) as total_commissions
from lines where from_file not in (select from_file from known) group by from_file""")
def dedupe_files(t: Tables):
    listed = ledger.file_entries(t.lines.filter((F.col("comm_month") < F.lit(dt.date(1999, 1, 1)))
                                                & (F.col("quantity") >= 25)), AS_OF)
    return ledger.new_files(t.lines, listed).groupBy("from_file").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("actual_comm_paid").cast("decimal(18,2)").alias("total_commissions"))


@query("files_in_history", ("lines",), """
select distinct from_file as filename from lines where comm_month>=date '2001-06-01'
intersect select distinct from_file from lines where comm_month<date '2001-06-01'""")
def files_in_history(t: Tables):
    cut = F.lit(dt.date(2001, 6, 1))
    new = ledger.file_entries(t.lines.filter(F.col("comm_month") >= cut), AS_OF)
    old = ledger.file_entries(t.lines.filter(F.col("comm_month") < cut), AS_OF)
    return ledger.known_files(new, old)


@query("principal_statement", ("lines", "salespeople", "principals"), "with " + REPORT_ROWS + """,
sums as (select salesperson, principal, sum(own) as c from report group by salesperson, principal),
grid as (select s.sales_initials as salesperson, p.full_name, coalesce(c,0) as c
 from salespeople s cross join principals p left join sums on sums.salesperson=s.sales_initials
  and sums.principal=p.abbreviation),
rolled as (select salesperson, full_name, cast(grouping(full_name) as int) as level,
  cast(sum(c) as decimal(18,2)) as sales_commission
 from grid group by grouping sets ((salesperson),(salesperson,full_name)))
select salesperson, case when level=1 then 'TOTAL COMMISSIONS DUE' else full_name end as line, level, sales_commission,
 concat(case when sales_commission<0 then '-$' else '$' end, format('{:,.2f}', cast(abs(sales_commission) as double))) as shown
from rolled""")
def principal_statement(t: Tables):
    return report.statement(per_person(t), t.principals, t.salespeople)


@query("finished_quarter", ("lines",), """
with m as (select max(comm_month) as m from lines),
s as (select cast(date_trunc('quarter', m + interval 1 month) - interval 3 month as date) as s from m)
select unique_id, comm_month, actual_comm_paid from lines, s
where comm_month>=s and comm_month<s + interval 3 month""")
def finished_quarter(t: Tables):
    return report.finished_quarter(t.lines).select("unique_id", "comm_month", "actual_comm_paid")


@query("remove_month", ("lines",), """
select comm_month, count(*) as n_lines, cast(sum(actual_comm_paid) as decimal(18,2)) as actual_comm_paid
from lines where comm_month<>date '2001-07-01' group by comm_month""")
def remove_month(t: Tables):
    return report.remove_month(t.lines, dt.date(2001, 7, 1)).groupBy("comm_month").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("actual_comm_paid").cast("decimal(18,2)").alias("actual_comm_paid"))


@query("data_quality_counts", ("lines",), """
select principal, count(*) as n_lines, count(*) filter (where reported_customer is null) as n_no_customer,
 count(*) filter (where actual_comm_paid=0) as n_no_commission,
 count(*) filter (where cm_sales is null and design_sales is null) as n_no_salesperson,
 count(*) filter (where not (2001-year(invoice_date) in (0,1) and invoice_date<=date '2001-12-31')) as n_bad_date,
 max(comm_month) as latest_month
from lines group by principal""")
def data_quality_counts(t: Tables):
    return report.data_quality_counts(t.lines, AS_OF)
