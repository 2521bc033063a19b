"""Canonical commission-line schema and column checks (S-17, S-18, P-5)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from repledger.functions.numbers import FRACTION, MONEY, SHARE, UNIT

RAW_SHEETS = "from_file string, sheet_name string, sheet_no int, row_idx long, cells map<string,string>"


@dataclass(frozen=True)
class Field:
    name: str
    header: str
    kind: str


# Sheet columns of a commission line with their headings and how their text is read.
MAPPED_FIELDS = (
    Field("reported_customer", "Reported Customer", "text"),
    Field("reported_distributor", "Reported Distributor", "text"),
    Field("part_number", "Part Number", "text"),
    Field("cust_part_number", "Cust Part Number", "text"),
    Field("invoice_date", "Invoice Date", "date"),
    Field("invoice_number", "Invoice Number", "text"),
    Field("po_number", "PO Number", "text"),
    Field("sales_order", "Sales Order #", "text"),
    Field("quantity", "Quantity", "number"),
    Field("unit_cost", "Unit Cost", "unit"),
    Field("unit_price", "Unit Price", "unit"),
    Field("ext_cost", "Ext. Cost", "money"),
    Field("invoiced_dollars", "Invoiced Dollars", "money"),
    Field("paid_on_revenue", "Paid-On Revenue", "money"),
    Field("actual_comm_paid", "Actual Comm Paid", "money"),
    Field("commission_rate", "Commission Rate", "percent"),
    Field("split_percentage", "Split Percentage", "percent"),
    Field("gross_rev_reduction", "Gross Rev Reduction", "percent"),
    Field("shared_rev_tier_rate", "Shared Rev Tier Rate", "percent"),
    Field("comm_source", "Comm Source", "text"),
    Field("city", "City", "text"),
    Field("zip_code", "Zip Code", "text"),
    Field("on_offshore", "On/Offshore", "text"),
    Field("inf_comm_type", "INF Comm Type", "text"),
    Field("pl", "PL", "text"),
    Field("division", "Division", "text"),
    Field("project", "Project", "text"),
    Field("product_category", "Product Category", "text"),
    Field("end_market", "End Market", "text"),
    Field("q_number", "Q Number", "text"),
    Field("cust_revenue_ytd", "Cust Revenue YTD", "money"),
    Field("total_nds", "Total NDS", "money"),
    Field("post_split_nds", "Post-Split NDS", "money"),
)

# Columns the processing itself adds, and where they stand among the mapped ones.
INJECTED = (
    (0, ("cm_sales", "design_sales")),
    (3, ("t_name", "cm", "t_end_cust")),
    (7, ("principal", "distributor")),
    (18, ("cm_sales_comm", "design_sales_comm", "sales_commission")),
    (22, ("quarter_shipped", "month", "year")),
)
TRAILING = ("cm_split", "paid_date", "from_file", "sales_report_date", "t_notes", "unique_id")

# Required columns of the supporting tables.
REQUIRED = {
    "salespeople": ("salesperson", "sales_initials", "sales_percentage", "territory_cities", "qq_split"),
    "principals": ("abbreviation",),
    "accounts": ("sls", "proper_name"),
    "lookup_master": ("cm_sales", "design_sales", "cm_split", "reported_customer", "cm", "part_number", "t_name",
                      "t_end_cust", "last_used", "principal", "city", "date_added"),
    "root_customers": ("root_customer", "salesperson"),
    "distributor_map": ("corrected_dist", "search_abbreviation"),
    "quarantined": ("last_used", "date_quarantined"),
    "invoice_log": ("inv_no", "part_number"),
    "files_processed": ("filename", "total_commissions", "date_added", "paid_date"),
    "insight_rows": ("root_customer", "root_customer_class", "customer_city", "sales"),
    "insight_master": ("root_customer", "current_sales"),
}

TYPE_OF_KIND = {"text": "string", "date": "date", "number": "bigint", "unit": UNIT, "money": MONEY,
                "percent": FRACTION}

LINE_TYPES = {
    **{f.name: TYPE_OF_KIND[f.kind] for f in MAPPED_FIELDS},
    "cm_sales_comm": SHARE, "design_sales_comm": SHARE, "sales_commission": SHARE,
    "year": "int", "cm_split": "int", "paid_date": "date", "sales_report_date": "date",
}


class MissingColumns(ValueError):
    """A table lacks columns an operator needs."""


class SchemaMismatch(ValueError):
    """Two tables that must have the same columns do not."""


def ordered_columns(mapped: list[str] | None = None) -> list[str]:
    """Column order of a finished commission line, each name once."""
    names = [f.name for f in MAPPED_FIELDS] if mapped is None else list(mapped)
    for position, added in INJECTED:
        names[position:position] = added
    return list(dict.fromkeys([*names, *TRAILING]))


def line_schema(mapped: list[str] | None = None) -> T.StructType:
    """Explicit schema of finished lines."""
    ddl = ", ".join(f"`{c}` {LINE_TYPES.get(c, 'string')}" for c in ordered_columns(mapped))
    return T.StructType.fromDDL(ddl)


def require_columns(df: DataFrame, table: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Refuse a table without its required columns; looks at the schema only."""
    missing = [c for c in (columns or REQUIRED[table]) if c not in df.columns]
    if missing:
        raise MissingColumns(f"{table}: missing {', '.join(missing)}")
    return df


def require_same_columns(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Refuse an append whose columns differ in either direction."""
    missing = [c for c in existing.columns if c not in new.columns]
    extra = [c for c in new.columns if c not in existing.columns]
    if missing or extra:
        raise SchemaMismatch(f"missing columns: {missing}; extra columns: {extra}")
    return new
