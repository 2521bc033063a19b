"""Commission tables derived from the driver's tables.

Each table is one SQL text that Spark and the checking engine both run; `{name}` stands for another table.
All of them cover the whole of the tables they are made from. No derivation sorts or numbers rows within a
key: ids and row positions come from the row's own values.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repledger.session import compiled

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations")

PRINCIPAL_CODES = ["ABR", "ISS", "ATS", "MIL", "OSR", "GLO", "QRF", "XMO", "GAN", "TRI", "LAT", "INF", "COS"]
# The code of a brand, by the brand's number.
PRINCIPAL_CODE = "case cast(substring(p_brand,7) as int)%{n} {whens} end".format(
    n=len(PRINCIPAL_CODES), whens=" ".join(f"when {k} then '{code}'" for k, code in enumerate(PRINCIPAL_CODES)))


def initials(key: str) -> str:
    return f"concat(chr(65+{key}),chr(65+{key}%5))"


def city(nation: str, balance: str) -> str:
    return f"concat('CITY ',cast({nation} as string),'-',cast(cast(floor({balance}/1000) as int) as string))"


MONEY = {
    "invoiced_dollars": "cast(l_extendedprice as decimal(12,2))",
    "paid_on_revenue": "cast(cast(l_extendedprice as decimal(12,2))*cast(1-l_discount as decimal(4,2)) as decimal(18,2))",
    "actual_comm_paid": "cast(cast(l_extendedprice as decimal(12,2))*cast(1-l_discount as decimal(4,2))"
                        "*cast(l_tax as decimal(4,2)) as decimal(18,2))",
}
# A row's place as text that sorts like its values: every part has the digits of its whole type, so no two rows share one.
ROW_IDX = "concat(%s)" % ",".join(f"lpad(cast({value} as string),{digits},'0')" for value, digits in (
    ("l_orderkey", 19), ("l_linenumber", 10), ("l_partkey", 19), ("l_suppkey", 19), ("cast(l_quantity as bigint)", 19)))


def row_chunk() -> Column:
    """Chunks of a sheet's consecutive rows: those of so many orders."""
    return F.expr("cast(substring(row_idx,1,19) as bigint) div 4096")


TABLES = {
    "lines": f"""
select md5(concat_ws('|',cast(l_orderkey as string),cast(l_linenumber as string),cast(l_partkey as string),
   cast(l_suppkey as string),cast(cast(l_quantity as int) as string),cast({MONEY['invoiced_dollars']} as string),
   cast(cast(l_discount as decimal(4,2)) as string),cast(cast(l_tax as decimal(4,2)) as string),
   cast(cast(l_shipdate as date) as string),l_returnflag,l_linestatus)) as unique_id,
 p_brand as principal, concat(p_brand,' ',cast(year(o_orderdate) as string)) as from_file,
 concat('Sheet ',l_returnflag) as sheet_name, {ROW_IDX} as row_idx,
 case when c_mktsegment='BUILDING' and l_returnflag='R' then null else c_name end as reported_customer,
 p_name as part_number,
 case when l_returnflag='N' and l_linestatus='O' then null else s_name end as reported_distributor,
 lpad(cast(l_orderkey as string),12,'0') as invoice_number,
 cast(l_shipdate as date) as invoice_date,
 case when o_orderpriority='4-NOT SPECIFIED' and l_linestatus='O' then null else
   concat(cast(year(l_shipdate) as string),'Q',cast(quarter(l_shipdate) as string)) end as quarter_shipped,
 cast(date_trunc('month',o_orderdate) as date) as comm_month,
 cast(l_quantity as bigint) as quantity,
 {MONEY['invoiced_dollars']} as invoiced_dollars, {MONEY['paid_on_revenue']} as paid_on_revenue,
 cast(l_tax as decimal(4,2)) as commission_rate, {MONEY['actual_comm_paid']} as actual_comm_paid,
 case when l_returnflag='A' then null else {initials('c_nationkey')} end as cm_sales,
 case when l_linenumber=4 then null when l_linenumber=5 then 'QQ' else {initials('s_nationkey')} end as design_sales,
 case when l_linenumber%3=0 then null when l_linenumber%3=1 then 20 else 50 end as cm_split,
 case when c_mktsegment='HOUSEHOLD' then concat('INDIVIDUAL ',cast(c_custkey as string)) else upper(c_name) end
   as t_end_cust,
 case when c_mktsegment='FURNITURE' then concat('OOT ',c_mktsegment) else c_mktsegment end as t_name,
 case when l_linenumber=7 then s_name else null end as cm,
 case when l_linestatus='O' then null else {city('c_nationkey', 'c_acctbal')} end as city,
 case when o_orderpriority='5-LOW' then 'Correction line' else null end as t_notes
from {{lineitem}} join {{orders}} on l_orderkey=o_orderkey join {{customer}} on o_custkey=c_custkey
 join {{part}} on l_partkey=p_partkey join {{supplier}} on l_suppkey=s_suppkey""",

    # Entries learned from all lines invoiced through 1997.
    "lookup_master": """
select md5(concat_ws('|',coalesce(reported_customer,'-'),part_number,coalesce(cm_sales,'-'),coalesce(design_sales,'-'),
   t_name,coalesce(cm,'-'),t_end_cust,coalesce(cast(cm_split as string),'-'))) as lookup_id,
 reported_customer, part_number, cm_sales, design_sales, t_name, cm, t_end_cust, cm_split,
 min(principal) as principal, case when t_name like 'OOT%' then null else min(city) end as city,
 max(invoice_date) as last_used, min(invoice_date) as date_added
from {lines} where invoice_date <= date '1997-12-31'
group by reported_customer, part_number, cm_sales, design_sales, t_name, cm, t_end_cust, cm_split""",

    "distributor_map": """
select regexp_replace(lower(s_name),'[^a-z0-9]','') as search_abbreviation, concat('Dist ',s_name) as corrected_dist
from {supplier} where s_acctbal >= 0
union all
select substring(s_name,10,9), concat('Overlap ',s_name) from {supplier} where s_acctbal >= 6000""",

    "principals": """
select distinct p_brand as abbreviation, concat('Maker ',p_brand) as full_name from {part}
union all select concat(r_name,' none'), concat('No sales ',r_name) from {region}""",

    "salespeople": f"""
select n_name as salesperson, {initials('n_nationkey')} as sales_initials,
 cast(40+n_nationkey%10 as decimal(9,6)) as sales_percentage,
 case when n_regionkey=4 then null else cast(4 as decimal(9,6)) end as qq_split
from {{nation}}""",

    "supplier_cities": f"""
select {initials('s_nationkey')} as sales_initials, {city('s_nationkey', 's_acctbal')} as city from {{supplier}}
union
select {initials('s_nationkey')}, concat('METRO ',cast(cast(floor(s_acctbal/50) as int) as string)) from {{supplier}}""",

    "accounts": f"""
select upper(c_name) as proper_name,
 case when c_acctbal > 9000 then null else {initials('c_nationkey')} end as sls,
 concat({city('c_nationkey', 'c_acctbal')},', ','CITY 99') as city, c_custkey as account_no
from {{customer}} where c_mktsegment in ('AUTOMOBILE','BUILDING')
union all
select upper(c_name), 'ZZ', 'CITY 98', -c_custkey-1 from {{customer}}
where c_mktsegment in ('AUTOMOBILE','BUILDING') and c_acctbal < 1000""",

    "root_customers": f"""
select c_name as root_customer, {initials('c_nationkey')} as salesperson, c_custkey as map_no
from {{customer}} where c_mktsegment='MACHINERY' or c_acctbal < 1000
union all
select lower(c_name), 'YY', -c_custkey-1 from {{customer}} where c_mktsegment='MACHINERY' and c_acctbal > 8000""",

    "insight_rows": f"""
select {ROW_IDX} as row_no, case when s_nationkey=3 then 'zz feedback'
   when s_nationkey=7 then concat({initials('s_nationkey')},' feedback ',l_returnflag)
   else concat({initials('s_nationkey')},' feedback') end as from_file, l_returnflag as sales_channel,
 case when l_returnflag='R' and l_linestatus='O' and c_mktsegment='FURNITURE' then null else concat(c_name,' ') end
   as root_customer,
 case c_mktsegment when 'HOUSEHOLD' then 'Individual ' when 'FURNITURE' then 'Contract Mfg' else 'Direct' end
   as root_customer_class,
 {city('case when l_linenumber=1 then s_nationkey else c_nationkey end', 'c_acctbal')} as customer_city,
 case when l_returnflag='A' then {initials('s_nationkey')} when l_returnflag='N' then lower({initials('s_nationkey')})
   else {initials('c_nationkey')} end as sales,
 case when l_linenumber=2 then 'n/a' else cast(cast(l_quantity as int) as string) end as qty_shipped,
 cast({MONEY['invoiced_dollars']} as string) as unit_price, cast(l_shipdate as date) as invoice_date, 'x' as send
from {{lineitem}} join {{orders}} on l_orderkey=o_orderkey join {{customer}} on o_custkey=c_custkey
 join {{supplier}} on l_suppkey=s_suppkey""",
}

# The sheet rows as numbers and names; Spark turns them into heading/text maps, the checking SQL reads them as they are.
TABLES["sheet_rows"] = f"""
select code, concat(code,' ',cast(year(o_orderdate) as string),'.xlsx') as from_file,
 case when code='ABR' then case l_returnflag when 'A' then 'Q Adj' when 'N' then 'MoComm' else 'Other' end
      when code='QRF' then case l_returnflag when 'A' then 'OEM' when 'N' then 'OFF' else 'POS' end
      when code='OSR' then case l_returnflag when 'A' then 'World POS' else concat('Direct ',l_returnflag) end
      else concat('Sheet ',l_returnflag) end as sheet_name,
 case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as sheet_no, {ROW_IDX} as row_idx,
 l_returnflag as flag, l_linestatus as status, l_linenumber as line_no, cast(l_quantity as bigint) as quantity,
 p_name as part, c_name as customer, s_name as supplier, {city('c_nationkey', 'c_acctbal')} as city,
 lpad(cast(l_orderkey as string),12,'0') as invoice, cast(l_shipdate as date) as ship_date,
 {MONEY['invoiced_dollars']} as dollars, {MONEY['paid_on_revenue']} as paid_on, {MONEY['actual_comm_paid']} as comm,
 cast(l_tax as decimal(4,2)) as rate
from (select *, {PRINCIPAL_CODE} as code from {{part}}) p
 join {{lineitem}} on l_partkey=p_partkey join {{orders}} on l_orderkey=o_orderkey
 join {{customer}} on o_custkey=c_custkey join {{supplier}} on l_suppkey=s_suppkey"""

TABLES["invoice_log"] = """
select lpad(cast(l_orderkey as string),12,'0') as inv_no, p_name as part_number
from {lineitem} join {part} on l_partkey=p_partkey where l_returnflag='N' and l_linestatus='F'"""

TABLES["sheet_principals"] = f"""
select distinct {PRINCIPAL_CODE} as abbreviation from {{part}} where {PRINCIPAL_CODE} <> 'COS'"""

# Spark joins the tables from left to right: customers meet orders before these meet the line items, whose rows are so
# dealt once by order, before they are wide, and parts and suppliers come last.
ORDERS = "({orders} join {customer} on o_custkey=c_custkey) on l_orderkey=o_orderkey"
JOIN_ORDER = (
    ("{orders} on l_orderkey=o_orderkey join {customer} on o_custkey=c_custkey", ORDERS),
    (f"""from (select *, {PRINCIPAL_CODE} as code from {{part}}) p
 join {{lineitem}} on l_partkey=p_partkey join {{orders}} on l_orderkey=o_orderkey
 join {{customer}} on o_custkey=c_custkey""", f"""from {{lineitem}} join {ORDERS}
 join (select *, {PRINCIPAL_CODE} as code from {{part}}) p on l_partkey=p_partkey"""))


def ordered(text: str) -> str:
    """A table's SQL with its joins in the order that moves the least; inner joins give the same rows in any."""
    for written, better in JOIN_ORDER:
        text = text.replace(written, better)
    return text


PLACEHOLDER = re.compile(r"\{(\w+)\}")


SCAN_TASKS = "spark.repledger.scanTasks"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows to as many tasks as the session asks for in `SCAN_TASKS`; by default they stay where they are read.

    It is for tables in a single file of one row group, which one task reads.
    """
    tasks = df.sparkSession.conf.get(SCAN_TASKS, None)
    return df.repartition(int(tasks), *keys) if tasks else df


class Tables:
    """The driver's tables and those derived from them, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._cache = compiled(spark), sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name == "lineitem":
            return spread(self.spark.read.parquet(f"{self.sf_dir}/lineitem.parquet"),
                          "l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
        if name in SOURCES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.sql(ordered(TABLES[name]))
        return self._cache[name]

    def sql(self, text: str) -> DataFrame:
        """Run SQL in which `{name}` is a table."""
        return self.spark.sql(text, **{n: getattr(self, n) for n in PLACEHOLDER.findall(text)})


def with_tables(body: str, uses: tuple[str, ...]) -> str:
    """`body` as one statement for the checking engine, the tables it uses as common table expressions."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES and name not in needed:
            for dep in PLACEHOLDER.findall(TABLES[name]):
                visit(dep)
            needed.append(name)

    for name in uses:
        visit(name)
    plain = {n: PLACEHOLDER.sub(r"\1", TABLES[n]).replace("'[^a-z0-9]','')", "'[^a-z0-9]','','g')") for n in needed}
    ctes = ",\n".join(f"{n} as ({plain[n].strip()})" for n in needed)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}" if ctes else body
    return f"with {ctes}\n{body}" if ctes else body
