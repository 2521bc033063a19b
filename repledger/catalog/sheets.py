"""Queries: exported sheets to canonical lines.

`raw_sheets` writes the sheet rows the way partners do, under each partner's headings and as text; the
checking SQL works on the numbers those texts were made from.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from repledger.catalog import tables
from repledger.catalog.registry import query
from repledger.catalog.tables import Tables
from repledger.functions import dates
from repledger.operators import calc, conform, issues, match, report, rules
from repledger.plans import flows
from repledger.session import remove_at_exit, shared_folder
from repledger.sources import ledger as files
from repledger.sources import readers, sinks
from repledger.streaming import ingest

# Header spellings of the example partners.
ALIASES = {
    "part_number": ["Part #", "Item No", "MPN"],
    "reported_customer": ["Customer", "Sold To", "Customer Name", "End Customer"],
    "reported_distributor": ["Distributor", "Disty"],
    "invoice_date": ["Date", "Ship Date", "Sales Date"],
    "invoice_number": ["Invoice", "Inv No", "BillDocNo"],
    "quantity": ["Qty"],
    "ext_cost": ["Extended Cost"],
    "invoiced_dollars": ["Extended Resale", "Sales Dollars"],
    "actual_comm_paid": ["Commission", "Comm Paid", "Commission Due"],
    "commission_rate": ["Rate", "Rep 1 %"],
    "city": ["Ship City"],
}


def _heading(default: str | None, **by_code: str | None) -> Column:
    """Heading by principal code; keys are codes joined by `_`, optionally with a flag as in `MIL_A`."""
    branches = None
    for key, name in by_code.items():
        code, _, flag = key.partition("_")
        when = F.col("code") == code
        if flag:
            when = when & F.col("flag").isin(*flag)
        branches = F.when(when, F.lit(name)) if branches is None else branches.when(when, F.lit(name))
    return F.lit(default) if branches is None else branches.otherwise(F.lit(default))


def _dollars(c: str) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.col(c), 2))


def _date_text() -> Column:
    d = F.col("ship_date")
    formats = {1: "yyyy-MM-dd", 2: "M/d/yyyy", 3: "yyyyMMdd", 4: "MMM d, yyyy", 5: "M/d/yy", 6: "yyyy-MM-dd 00:00:00"}
    branches = None
    for line, pattern in formats.items():
        value = F.date_format(d, pattern.replace(" 00:00:00", " HH:mm:ss"))
        branches = F.when(F.col("line_no") == line, value) if branches is None else branches.when(
            F.col("line_no") == line, value)
    return branches.otherwise(F.lit("no date"))


LANDED: dict[tuple[str, str], str] = {}


def raw_sheets(t: Tables) -> DataFrame:
    """The exported sheets of a folder of tables, as files in the shared folder.

    They are written once per application: sheets arrive as files, and conforming reads them more than once.
    """
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in LANDED:
        path = f"{shared_folder(t.spark).rstrip('/')}/sheets-{uuid.uuid4().hex}"
        exported_sheets(t).write.option("compression", sinks.CODEC).parquet(path)  # by the tasks that join the rows: as maps of cells they are not moved
        LANDED[key] = remove_at_exit(t.spark, path)
    return t.spark.read.schema(exported_sheets(t).schema).parquet(LANDED[key])


def exported_sheets(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    """The sheet rows (or those of `rows`) under their partners' headings, as text."""
    line, flag, status = F.col("line_no"), F.col("flag"), F.col("status")
    part = (F.when((F.col("code") == "MIL") & (F.col("quantity") == 50), F.lit("Totals"))
            .when((status == "O") & (F.col("quantity") == 1), F.lit("nan")).otherwise(F.col("part")))
    distributor = (F.when((F.col("code") == "ATS") & (line <= 2), F.concat(F.lit("DIGI "), F.col("supplier")))
                   .when((F.col("code") == "ATS") & (line == 3), F.lit("Mouser"))
                   .when((F.col("code") == "ABR") & (flag == "N"), F.when(line == 1, F.col("supplier")))
                   .otherwise(F.col("supplier")))
    points = F.concat((F.col("rate") * 100).cast("int").cast("string"), F.lit("%"))
    rate = F.when(flag == "A", points).otherwise(F.col("rate").cast("string"))
    dollars = F.when((F.col("code") == "GAN") & (F.col("quantity") == 2), F.lit("n/a")).otherwise(_dollars("dollars"))
    cells = [
        (_heading("Part Number", ISS="Item No", ATS=" Part # ", MIL_NR=None, OSR="Part #", GLO="MPN", QRF="MPN",
                  GAN="Part #", TRI="Item No"), part),
        (_heading("Customer", ISS="Sold To", QRF="Sold To", OSR="Reported Customer"),
         F.concat(F.lit(" "), F.col("customer"), F.lit(" "))),
        (_heading(None, OSR="Customer Name", QRF="End Customer"), F.lit("other name")),
        (_heading(None, OSR="Item", QRF="Item"), F.lit("other item")),
        (_heading("Disty", QRF_R="Company", ATS="Reported Distributor"), distributor),
        (_heading("Ship Date", ABR="Invoice Date", OSR="Date", INF_N=None), _date_text()),
        (_heading(None, OSR="Sales Date"), F.lit("1/1/1990")),
        (_heading("Inv No", QRF_R="Invoice"), F.col("invoice")),
        (_heading(None, QRF_R="BillDocNo"), F.lit("77")),
        (_heading("Qty"), F.when((F.col("code") == "TRI") & (F.col("quantity") == 13), F.lit("abc")).otherwise(
            F.col("quantity").cast("string"))),
        (_heading(None, LAT_R="Quantity"), F.lit("1")),
        (_heading("Sales Dollars", ATS="Resale", MIL_A=None), dollars),
        (_heading(None, ATS="Cost", MIL_A="Ext. Cost"), _dollars("paid_on")),
        (_heading(None, LAT="Paid-On Revenue", INF="Paid-On Revenue", MIL_NR="Paid-On Revenue"), _dollars("paid_on")),
        (_heading("Comm Paid", ABR_A=None, GLO_A=None, INF_A=None, XMO="Amount"), _dollars("comm")),
        (_heading(None, ISS="Commission Due", XMO="Commission Due"), F.lit("0.01")),
        (_heading("Rate", ABR=None, GLO_AN=None, OSR="Rep 1 %"),
         F.when((F.col("code") == "OSR") & (line == 6), F.lit("")).otherwise(rate)),
        (_heading(None, OSR="Rep 2 %"), rate),
        (_heading(None, ISS="Name"), F.when(line <= 3, F.lit("OEM direct")).otherwise(F.lit("POS"))),
        (_heading(None, ISS="Sales Region"), F.concat(F.lit("Region "), F.col("city"))),
        (_heading("Ship City"), F.col("city")),
        (_heading("Unnamed: 3"), F.lit("stray")),
    ]
    rows = t.sheet_rows if rows is None else rows
    # All cells first, by compiled code; then those that have a heading.
    written = rows.select("from_file", "sheet_name", "sheet_no", "row_idx",
                          F.array(*[F.struct(h.alias("key"), v.cast("string").alias("value")) for h, v in cells]).alias("_all"))
    headed = F.filter("_all", lambda e: e["key"].isNotNull())
    return written.select("from_file", "sheet_name", "sheet_no", "row_idx",
                          F.when(F.size("_all") > 0, F.map_from_entries(headed)).alias("cells"))


def staged_sheets(t: Tables) -> DataFrame:
    """The mapped rows, stored once for the steps that read them."""
    mapped = conform.map_columns(conform.clean_cells(raw_sheets(t), ALIASES))
    return sinks.stager(shared_folder(t.spark))(mapped)


def typed_sheets(t: Tables, mapped: DataFrame, fill: bool = False) -> DataFrame:
    listed = conform.known_principals(mapped, t.sheet_principals)
    if fill:
        listed = rules.fill_monthly_sheets(listed, tables.row_chunk())
    return conform.typed_lines(listed, conform.sheet_profile(mapped, ALIASES))


def conformed(t: Tables):
    return conform.conform(raw_sheets(t), ALIASES, t.sheet_principals, t.distributor_map, t.invoice_log,
                           fill_chunk=tables.row_chunk(), stage=sinks.stager(shared_folder(t.spark)))


# What the sheets should come out as, from the numbers behind them.
RULED = """src as (select *,
  case when code='MIL' and flag in ('N','R') then null when code='MIL' and quantity=50 then 'Totals'
   when status='O' and quantity=1 then null else part end as part_cell,
  case when code='ATS' and line_no<=2 then concat('DIGI ',supplier) when code='ATS' and line_no=3 then 'Mouser'
   when code='ABR' and flag='N' then case when line_no=1 then supplier end else supplier end as dist_cell,
  case when line_no<=6 then ship_date end as date_cell,
  case when code='TRI' and quantity=13 then null else quantity end as qty_cell,
  case when code='MIL' and flag='A' then null when code='GAN' and quantity=2 then null else dollars end as dollars_cell,
  case when code='ATS' or (code='MIL' and flag='A') then paid_on end as cost_cell,
  case when code in ('LAT','INF') or (code='MIL' and flag in ('N','R')) then paid_on end as paid_cell,
  case when (code='ABR' and flag='A') or (code='GLO' and flag='A') or (code='INF' and flag='A') then null else comm end as comm_cell,
  case when code='ABR' or (code='GLO' and flag in ('A','N')) then null when flag='A' then rate*100 else rate end as rate_cell
 from sheet_rows),
typed as (select *, cast(case when max(rate_cell) over (partition by from_file,sheet_name)>1
   then rate_cell*cast(0.01 as decimal(3,2)) else rate_cell end as decimal(9,6)) as rate_typed
 from src where code<>'COS' and not (code='LAT' and flag='R'))"""

CHAIN = RULED + """,
filled as (select *, case when code='ABR' and flag='N' then
   last_value(dist_cell ignore nulls) over (partition by from_file,sheet_name order by row_idx) else dist_cell end as dist_filled,
  (select count(*) from distributor_map d where typed.code='ISS' and typed.line_no<=3
    and contains(regexp_replace(lower(typed.customer),'[^a-z0-9]','','g'), d.search_abbreviation)) as hits
 from typed),
log as (select inv_no, max(part_number) as part_number from invoice_log group by inv_no having count(*)=1),
ruled as (select from_file, sheet_name, row_idx, code as principal, flag,
 case when code='MIL' and flag in ('N','R') then coalesce(log.part_number,'NOT FOUND') else part_cell end as part_number,
 customer as reported_customer,
 case when code='ISS' and line_no<=3 and hits=1 then customer when code='OSR' and flag='A' then 'World Star'
  else dist_filled end as reported_distributor,
 date_cell as invoice_date, qty_cell as quantity,
 cast(case when code='GAN' and quantity=2 then 0 else dollars_cell end as decimal(18,2)) as invoiced_dollars,
 cast(cost_cell as decimal(18,2)) as ext_cost,
 cast(case when code='ABR' and flag='A' then cast(dollars*cast(0.7 as decimal(2,1)) as decimal(18,2))
  when code='MIL' and flag='A' then cost_cell
  when code in ('ATS','OSR','GLO','QRF','XMO','GAN','TRI') or (code='ABR' and flag='N')
   then case when code='GAN' and quantity=2 then 0 else dollars end
  else paid_cell end as decimal(18,2)) as paid_on_revenue,
 cast(case when code='ABR' and flag='A' then cast(cast(dollars*cast(0.7 as decimal(2,1)) as decimal(18,2))*cast(0.03 as decimal(3,2)) as decimal(18,2))
  when code='GLO' and flag='A' then cast(dollars*cast(0.05 as decimal(3,2)) as decimal(18,2)) else comm_cell end as decimal(18,2)) as actual_comm_paid,
 cast(case when code='ABR' and flag='A' then 0.03
  when code='ABR' and flag='N' then round_even(cast(comm_cell as double)/cast(dollars as double),3)
  when code='GLO' and flag in ('A','N') then 0.05 else rate_typed end as decimal(9,6)) as commission_rate,
 case when code='ABR' then case when flag in ('A','N') then 'Resale' end
  when code='ATS' then case when line_no<=3 then 'Cost' else 'Resale' end
  when code='MIL' then case when flag='A' then 'Cost' else 'Resale' end
  when code in ('LAT','INF') then null else 'Resale' end as comm_source,
 case when code='ISS' and line_no<=3 then concat('Region ',city) else city end as city
 from filled left join log on log.inv_no=filled.invoice and code='MIL' and flag in ('N','R')
 where not (code='MIL' and flag='A' and quantity=50))"""

SHEETS = ("sheet_rows", "distributor_map", "invoice_log")
OUT = ("from_file", "sheet_name", "row_idx", "principal", "part_number", "reported_customer", "reported_distributor",
       "invoice_date", "quantity", "invoiced_dollars", "ext_cost", "paid_on_revenue", "actual_comm_paid",
       "commission_rate", "comm_source", "city")


@query("conform_columns", ("sheet_rows",), """
select from_file, sheet_name, row_idx, code as principal,
 case when code='MIL' and flag in ('N','R') then null when code='MIL' and quantity=50 then 'Totals'
  when status='O' and quantity=1 then null else part end as part_number,
 customer as reported_customer, invoice as invoice_number, city,
 case when code='ISS' then case when line_no<=3 then 'OEM direct' else 'POS' end end as oem_pos
from sheet_rows""")
def conform_columns(t: Tables):
    return conform.map_columns(conform.clean_cells(raw_sheets(t), ALIASES)).select(
        "from_file", "sheet_name", "row_idx", "principal", "part_number", "reported_customer", "invoice_number", "city",
        "oem_pos")


@query("sheet_profile", ("sheet_rows",), """
select from_file, sheet_name, code as principal, count(*) as n_rows,
 case when code='LAT' and flag='R' then 'quantity' else '' end as ambiguous,
 not (code='MIL' and flag in ('N','R')) as has_part_number,
 not ((code='ABR' and flag='A') or (code='GLO' and flag='A') or (code='INF' and flag='A')) as has_actual_comm_paid,
 not (code='ABR' or (code='GLO' and flag in ('A','N'))) as has_commission_rate,
 cast(case when not (code='ABR' or (code='GLO' and flag in ('A','N'))) then
  max(rate)*case when flag='A' then 100 else 1 end end as decimal(18,6)) as max_commission_rate
from sheet_rows group by from_file, sheet_name, code, flag""")
def sheet_profile(t: Tables):
    mapped = conform.map_columns(conform.clean_cells(raw_sheets(t), ALIASES))
    return conform.sheet_profile(mapped, ALIASES).select(
        "from_file", "sheet_name", "principal", "n_rows", F.array_join("ambiguous", ", ").alias("ambiguous"),
        *[F.array_contains("present", c).alias(f"has_{c}") for c in ("part_number", "actual_comm_paid", "commission_rate")],
        "max_commission_rate")


@query("parse_money_pct", ("sheet_rows",), "with " + RULED + """
select row_idx, qty_cell as quantity, cast(dollars_cell as decimal(18,2)) as invoiced_dollars,
 cast(cost_cell as decimal(18,2)) as ext_cost, cast(comm_cell as decimal(18,2)) as actual_comm_paid,
 rate_typed as commission_rate,
 case when (code='TRI' and quantity=13) or (code='GAN' and quantity=2) then 1 else 0 end as n_unparsed
from typed""")
def parse_money_pct(t: Tables):
    return typed_sheets(t, staged_sheets(t)).select("row_idx", "quantity", "invoiced_dollars", "ext_cost", "actual_comm_paid", "commission_rate",
                        F.size("bad_cells").alias("n_unparsed"))


@query("parse_dates", ("sheet_rows",), """
with d as (select row_idx, line_no, case when line_no<=6 then ship_date end as invoice_date from sheet_rows)
select row_idx, invoice_date, line_no>6 as unreadable, cast(year(invoice_date) as int) as year,
 strftime(invoice_date,'%b') as month,
 case when invoice_date is not null then concat(cast(year(invoice_date) as varchar),'Q',cast(quarter(invoice_date) as varchar)) end
  as quarter_shipped from d""")
def parse_dates(t: Tables):
    texts = t.sheet_rows.select("row_idx", _date_text().alias("raw"))
    parsed = texts.withColumn("invoice_date", dates.parse_date(F.col("raw")))
    return calc.calendar_columns(parsed).select(
        "row_idx", "invoice_date", (F.col("raw").isNotNull() & F.col("invoice_date").isNull()).alias("unreadable"),
        "year", "month", "quarter_shipped")


@query("principal_rules", SHEETS, "with " + CHAIN + """
select principal, sheet_name, comm_source, count(*) as n_lines, cast(sum(invoiced_dollars) as decimal(18,2)) as invoiced_dollars,
 cast(sum(paid_on_revenue) as decimal(18,2)) as paid_on_revenue,
 cast(sum(actual_comm_paid) as decimal(18,2)) as actual_comm_paid,
 cast(sum(commission_rate) as decimal(18,6)) as sum_rate, count(reported_distributor) as n_distributor
from ruled where invoice_date is not null and not (principal='INF' and flag='N') group by principal, sheet_name, comm_source""")
def principal_rules(t: Tables):
    mapped = staged_sheets(t)
    ruled = rules.ruled_lines(typed_sheets(t, mapped, fill=True), rules.customer_hits(mapped, t.distributor_map), t.invoice_log)
    return ruled.filter(F.col("invoice_date").isNotNull()).groupBy("principal", "sheet_name", "comm_source").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("invoiced_dollars").cast("decimal(18,2)").alias("invoiced_dollars"),
        F.sum("paid_on_revenue").cast("decimal(18,2)").alias("paid_on_revenue"),
        F.sum("actual_comm_paid").cast("decimal(18,2)").alias("actual_comm_paid"),
        F.sum("commission_rate").cast("decimal(18,6)").alias("sum_rate"),
        F.count("reported_distributor").alias("n_distributor"))


ELIGIBLE = """ruled where part_number is not null and coalesce(actual_comm_paid,0)<>0
 and not (principal='INF' and flag in ('A','N'))"""


@query("eligible_lines", SHEETS, "with " + CHAIN + f"\nselect {', '.join(OUT)} from {ELIGIBLE}")
def eligible_lines(t: Tables):
    return conformed(t)[0].select(*OUT)


@query("conformed_file_totals", SHEETS, "with " + CHAIN + f"""
select from_file, sheet_name, cast(grouping(sheet_name) as int) as level, count(*) as n_lines,
 cast(sum(actual_comm_paid) as decimal(18,2)) as total_commissions from {ELIGIBLE}
group by grouping sets ((from_file,sheet_name),(from_file))""")
def conformed_file_totals(t: Tables):
    return report.file_totals(conformed(t)[0])


@query("fill_down_distributor", ("sheet_rows",), """
select row_idx, from_file, sheet_name,
 last_value(case when line_no=1 then supplier end ignore nulls)
  over (partition by from_file, sheet_name order by row_idx) as distributor
from sheet_rows""")
def fill_down_distributor(t: Tables):
    written = t.sheet_rows.select("row_idx", "from_file", "sheet_name",
                                  F.when(F.col("line_no") == 1, F.col("supplier")).alias("distributor"))
    return rules.fill_down(written, "distributor", chunk=tables.row_chunk())


@query("invoice_log_lookup", ("sheet_rows", "invoice_log"), """
with log as (select inv_no, max(part_number) as p from invoice_log group by inv_no having count(*)=1)
select row_idx, invoice as invoice_number, coalesce(p,'NOT FOUND') as part_number
from sheet_rows left join log on inv_no=invoice""")
def invoice_log_lookup(t: Tables):
    rows = t.sheet_rows.select("row_idx", F.col("invoice").alias("invoice_number"))
    return rules.with_invoice_log(rows, t.invoice_log, F.lit(True)).select(
        "row_idx", "invoice_number", F.coalesce("logged_part", F.lit(rules.NOT_FOUND)).alias("part_number"))


@query("standardise_lines", ("lines",), """
with rates as (select max(commission_rate) as top from lines)
select unique_id, cm_sales, design_sales, upper(principal) as principal, coalesce(cm_split,20) as cm_split,
 cast(actual_comm_paid as decimal(18,2)) as actual_comm_paid, cast(commission_rate as decimal(9,6)) as commission_rate,
 nullif(case when quantity=50 then 0 else quantity end,0) as quantity, invoice_date, invoice_number,
 cast(cast(invoice_number as bigint) as decimal(18,6)) as customer_number_num
from lines""")
def standardise_lines(t: Tables):
    exported = t.lines.select(
        "unique_id", F.concat(F.lit(" "), F.lower("cm_sales")).alias("cm_sales"),
        F.coalesce(F.col("design_sales"), F.lit("nan")).alias("design_sales"), F.lower("principal").alias("principal"),
        F.coalesce(F.col("cm_split").cast("string"), F.lit("0")).alias("cm_split"),
        F.concat(F.lit("$"), F.format_number("actual_comm_paid", 2)).alias("actual_comm_paid"),
        F.concat((F.col("commission_rate") * 100).cast("string"), F.lit("%")).alias("commission_rate"),
        F.when(F.col("quantity") == 50, "0").otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.date_format("invoice_date", "M/d/yyyy").alias("invoice_date"), "invoice_number",
        F.col("invoice_number").alias("customer_number"))
    typed = readers.numeric_sibling(calc.blank_zeros(readers.read_exported_lines(exported)), ["customer_number"])
    return typed.select("unique_id", "cm_sales", "design_sales", "principal", "cm_split", "actual_comm_paid",
                        "commission_rate", "quantity", "invoice_date", "invoice_number", "customer_number_num")


@query("issues", ("sheet_rows",), """
with sheets as (select distinct from_file, sheet_name, code, flag from sheet_rows),
found as (
 select 'conform' as operator, 'AMBIGUOUS_MAPPING' as code, true as fatal, from_file from sheets where code='LAT' and flag='R'
 union all select distinct 'conform', 'UNKNOWN_PRINCIPAL', true, from_file from sheets where code='COS'
 union all select 'conform', 'NO_COMMISSION_COLUMN', false, from_file from sheets where code='INF' and flag='A'
 union all select 'conform', 'NO_INVOICE_DATE_COLUMN', false, from_file from sheets where code='INF' and flag='N'
 union all select 'conform', 'UNRECOGNISED_SHEET', false, from_file from sheets where code='ABR' and flag='R'
 union all select 'conform', 'UNPARSED_MONEY', false, from_file from sheet_rows
  where (code='TRI' and quantity=13) or (code='GAN' and quantity=2)
 union all select 'conform', 'UNDECIDED_DATES', false, from_file from sheet_rows
  where line_no in (2,5) and not (code='INF' and flag='N') group by from_file, sheet_name
  having not bool_or(day(ship_date)>12) and bool_or(day(ship_date)<>month(ship_date)))
select operator, code, fatal, from_file, count(*) as n_issues from found group by all""")
def all_issues(t: Tables):
    out = conform.conform_sheets(raw_sheets(t), ALIASES, t.sheet_principals, t.distributor_map, t.invoice_log,
                                 fill_chunk=tables.row_chunk(), stage=sinks.stager(shared_folder(t.spark)))
    return issues.summarise(issues.gather([out.issues, out.undecided_dates()]))


UNMAPPED = "(code='LAT' and flag='R')"
REFUSED = f"select distinct from_file from sheet_rows where code='COS' or {UNMAPPED}"
# Sheets that cannot be mapped, and rows with a cell that cannot be read.
FAULTY = f"({UNMAPPED} or (code='TRI' and quantity=13) or (code='GAN' and quantity=2))"


def mended_sheets(t: Tables) -> DataFrame:
    """The exported sheets without the faulty ones and the rows that cannot be read, from where they have landed.

    Rows without a workbook's name cannot come again: the ledger would not know them.
    """
    def written(heading):
        return F.coalesce(F.try_element_at("cells", F.lit(heading)), F.lit(""))

    code = F.substring("from_file", 1, 3)
    faulty = ((code == "LAT") & (F.col("sheet_name") == "Sheet R") | (code == "TRI") & (written("Qty") == "abc")
              | (code == "GAN") & (written("Sales Dollars") == "n/a"))
    return raw_sheets(t).filter(~faulty & F.col("from_file").isNotNull())


@query("process_files_ledger", SHEETS, "with " + CHAIN + f""",
faulty as (select row_idx from sheet_rows where {FAULTY}),
refused as (select distinct from_file from sheet_rows where {FAULTY}),
totals as (select from_file, cast(sum(actual_comm_paid) as decimal(18,2)) as t from {ELIGIBLE}
 and row_idx not in (select row_idx from faulty) group by from_file),
read as (select distinct from_file from sheet_rows where code<>'COS' and not ({FAULTY}))
select read.from_file as filename, coalesce(t,cast(0 as decimal(18,2))) as total_commissions,
 case when read.from_file in (select from_file from refused) then date '2002-01-31' else date '2001-12-31' end as date_added
from read left join totals on totals.from_file=read.from_file""")
def process_files_ledger(t: Tables):
    """The ledger after two runs: files that cannot be mapped, or have a cell that cannot be read, are refused whole, and
    read when they come again without the fault. The second delivery has all files, of which the ledger knows the most."""
    dims = flows.Dimensions(principals=t.sheet_principals, distributor_map=t.distributor_map, invoice_log=t.invoice_log)
    store = sinks.stager(shared_folder(t.spark))
    ledger = t.spark.createDataFrame([], "filename string, total_commissions string, date_added date, paid_date date")
    for raw, day in ((raw_sheets(t), dt.date(2001, 12, 31)), (mended_sheets(t), dt.date(2002, 1, 31))):
        lines, read, _ = flows.accepted_lines(raw, ledger, ALIASES, dims, day, fill_chunk=tables.row_chunk(), stage=store,
                                              refuse_unreadable=True)
        ledger = store(files.append_entries(ledger, files.file_entries(lines, day, read)))
    return ledger.drop("paid_date")


@query("drop_reasons", SHEETS, "with " + CHAIN + f""",
refused as ({REFUSED}),
judged as (select case when principal='INF' and flag='A' then 'no_commission_column' when principal='INF' and flag='N' then 'no_invoice_date_column'
  when part_number is null then 'no_part_number' when coalesce(actual_comm_paid,0)=0 then 'zero_commission' else 'kept' end as reason
 from ruled where from_file not in (select from_file from refused)),
found as (select reason from judged union all select 'refused' from sheet_rows where from_file in (select from_file from refused)
 union all select 'totals_line' from sheet_rows where code='MIL' and flag='A' and quantity=50)
select reason, count(found.reason) as n_rows from (select unnest(['kept','refused','totals_line','no_part_number_column','no_commission_column',
 'no_invoice_date_column','no_part_number','zero_commission']) as reason) left join found using (reason) group by reason""")
def drop_reasons(t: Tables):
    """Rows of all sheets by what became of them, counted while the lines are written."""
    store, drops = sinks.stager(shared_folder(t.spark)), Observation()
    out = conform.conform_sheets(raw_sheets(t), ALIASES, t.sheet_principals, t.distributor_map, t.invoice_log,
                                 fill_chunk=tables.row_chunk(), stage=store, drops=drops)
    store(out.lines)
    return out.drop_reasons()


@query("run_counters", (*SHEETS, "lookup_master"), "with " + CHAIN + f""",
refused as (select distinct from_file from sheet_rows where code='COS' or {UNMAPPED}),
look as (select lower(coalesce(reported_customer,'')) as c, lower(part_number) as p, count(*) as n,
  max(coalesce(cm_sales,design_sales)) as who from lookup_master group by 1, 2),
kept as (select from_file, count(*) as n_lines, count(*) filter (where n=1 and who is not null) as n_matched
 from (select * from {ELIGIBLE}) e left join look on c=lower(coalesce(reported_customer,'')) and p=lower(part_number)
 group by from_file),
read as (select from_file, count(*) as n_rows from sheet_rows where from_file not in (select from_file from refused) group by 1)
select read.from_file, n_rows, coalesce(n_lines,0) as n_lines, n_rows-coalesce(n_lines,0) as n_dropped,
 coalesce(n_matched,0) as n_matched from read left join kept on kept.from_file=read.from_file""")
def run_counters(t: Tables):
    """What a run over all sheets read, dropped and matched, by file."""
    dims = flows.Dimensions(principals=t.sheet_principals, distributor_map=t.distributor_map, invoice_log=t.invoice_log)
    ledger = t.spark.createDataFrame([], "filename string, total_commissions string, date_added date, paid_date date")
    store = sinks.stager(shared_folder(t.spark))
    lines, read, _ = flows.accepted_lines(raw_sheets(t), ledger, ALIASES, dims, dt.date(2001, 12, 31),
                                          fill_chunk=tables.row_chunk(), stage=store)
    matched = match.match_lookup(flows.canonical(lines), t.lookup_master, F.col("lookup_id"), with_options=False)
    return report.run_counters(raw_sheets(t).join(read, "from_file", "left_semi"), matched)


@query("incremental_ingest", ("lines",), """
select from_file, sheet_name, cast(grouping(sheet_name) as int) as level, count(*) as n_lines,
 cast(sum(actual_comm_paid) as decimal(18,2)) as total_commissions
from lines group by grouping sets ((from_file,sheet_name),(from_file))""")
def incremental_ingest(t: Tables):
    """File totals of line items that arrive in two deliveries of several files, read file by file; equals `file_totals`."""
    folder = remove_at_exit(t.spark, f"{shared_folder(t.spark).rstrip('/')}/ingest-{uuid.uuid4().hex}")
    lineitem = t.spark.read.parquet(f"{t.sf_dir}/lineitem.parquet")

    def totals(batch: DataFrame) -> dict[str, DataFrame]:
        arrived = Tables(batch.sparkSession, t.sf_dir)
        arrived.__dict__["lineitem"] = batch
        return {"file_totals": report.file_totals(arrived.lines)}

    half = F.pmod(F.xxhash64("l_orderkey"), F.lit(2))
    for delivery in (0, 1):
        lineitem.filter(half == delivery).repartition(2, "l_partkey").write.mode("append").parquet(f"{folder}/landing")
        stream = ingest.file_stream(t.spark, f"{folder}/landing", "parquet", lineitem.schema, maxFilesPerTrigger=1)
        ingest.run_available(stream, f"{folder}/work", totals)
    return report.merged_file_totals(ingest.read_output(t.spark, f"{folder}/work", "file_totals"))


EVEN_YEAR = "cast(substring(from_file,5,4) as int)%2=0"


@query("streamed_conform", SHEETS, "with " + CHAIN + f""",
totals as (select from_file, count(*) as n, cast(sum(actual_comm_paid) as decimal(18,2)) as t from {ELIGIBLE} group by from_file),
refused as ({REFUSED}),
mended as (select from_file from refused where from_file like 'LAT%' and {EVEN_YEAR}),
read as (select distinct from_file from sheet_rows where from_file not in (select from_file from refused)
 union all select from_file from mended)
select from_file as filename, case when read.from_file is not null then coalesce(t,cast(0 as decimal(18,2))) end as total_commissions,
 case when read.from_file is not null then coalesce(n,0) else 0 end as n_lines, (refused.from_file is not null)::int as times_refused
from read full outer join refused using (from_file) left join totals using (from_file)""")
def streamed_conform(t: Tables):
    """Files entered and refused over two deliveries as a stream: half of the workbooks; the rest with some again and with
    corrected copies of those that were refused for a sheet."""
    folder = remove_at_exit(t.spark, f"{shared_folder(t.spark).rstrip('/')}/stream-{uuid.uuid4().hex}")
    rows, written = t.sheet_rows, exported_sheets(t)
    even = F.expr(EVEN_YEAR)
    repeated = even & (F.substring("from_file", 1, 3) == "ABR")
    mended = rows.filter(f"code='LAT' and not {UNMAPPED} and {EVEN_YEAR}")
    dims = flows.Dimensions(principals=t.sheet_principals, distributor_map=t.distributor_map, invoice_log=t.invoice_log)
    store = sinks.stager(shared_folder(t.spark))
    for delivery in (rows.filter(even), rows.filter(~even | repeated).unionByName(mended)):
        # Dealt by ranges before the cells become maps, so a large workbook is written by several tasks.
        dealt = delivery.repartitionByRange("from_file", "row_idx").sortWithinPartitions("from_file")
        exported_sheets(t, dealt).write.mode("append").partitionBy("from_file").parquet(f"{folder}/landing")
        stream = ingest.file_stream(t.spark, f"{folder}/landing", "parquet", written.schema).select(*written.columns)
        ingest.run_conform(stream, f"{folder}/work", ALIASES, dims, dt.date(2001, 12, 31), store, fill_chunk=tables.row_chunk())
    ledger, lines, refused = (ingest.read_committed(t.spark, f"{folder}/work", n) for n in ("ledger", "lines", "refused"))
    name = F.col("from_file").alias("filename")
    counts = lines.groupBy(name).agg(F.count(F.lit(1)).alias("n_lines"))
    times = refused.groupBy(name).agg(F.count(F.lit(1)).cast("int").alias("times_refused"))
    named = ledger.select("filename", "total_commissions").unionByName(
        refused.select(name).distinct().join(ledger, "filename", "left_anti"), allowMissingColumns=True)
    return named.join(counts, "filename", "left").join(times, "filename", "left").select(
        "filename", "total_commissions", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
        F.coalesce("times_refused", F.lit(0)).alias("times_refused"))
