"""Loaders for exported sheets, commission lines and supporting tables (S-1..S-16)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repledger.functions import dates, numbers, text
from repledger.sources import schema

FORMATS = ("parquet", "json", "csv", "orc")
DEFAULT_SPLIT = 20
UNTYPED_IDS = ("invoice_number", "part_number", "principal")


def read_table(spark: SparkSession, paths: str | list[str], fmt: str = "parquet", ddl: str | None = None) -> DataFrame:
    """One table from files in a Spark format; text formats take an explicit schema rather than inferring one."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt}")
    reader = spark.read.format(fmt)
    if ddl:
        reader = reader.schema(ddl)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(paths)


def snake(header: str) -> str:
    """`'Root Customer..'` as `root_customer`."""
    words = "".join(ch if ch.isalnum() else " " for ch in header.lower()).split()
    return "_".join(words)


def snake_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake(c) for c in df.columns])


def read_raw_sheets(spark: SparkSession, paths: str | list[str], fmt: str = "json") -> DataFrame:
    """All sheets of all exported workbooks in one scan, every cell as text (S-1)."""
    return read_table(spark, paths, fmt, schema.RAW_SHEETS)


def first_sheet(raw: DataFrame) -> DataFrame:
    """The first sheet of every workbook (S-2)."""
    return raw.filter(F.col("sheet_no") == 0)


def read_feedback(spark: SparkSession, paths: list[str], fmt: str = "csv") -> DataFrame:
    """A batch of feedback files, each row with the name of the file it came from (S-3)."""
    df = read_table(spark, paths, fmt).withColumn("from_file", F.col("_metadata.file_name"))
    return snake_headers(df)


def load_salespeople(df: DataFrame) -> DataFrame:
    """Salespeople with percentages defaulted to 0 and territory cities as one text, split where they are used (S-4)."""
    df = schema.require_columns(df, "salespeople")
    return df.select(
        text.blank_to_null(F.col("salesperson")).alias("salesperson"),
        text.initials(F.col("sales_initials")).alias("sales_initials"),
        F.coalesce(F.col("sales_percentage").try_cast(numbers.FRACTION), F.lit(0)).cast(numbers.FRACTION)
        .alias("sales_percentage"),
        F.coalesce(F.col("qq_split").try_cast(numbers.FRACTION), F.lit(0)).cast(numbers.FRACTION).alias("qq_split"),
        text.blank_to_null(F.col("territory_cities")).alias("territory_cities"))


def load_dimension(df: DataFrame, table: str) -> DataFrame:
    """A supporting table: required columns present, text trimmed, blanks as NULL (S-5, S-9, S-11..S-13, S-15, S-16)."""
    df = schema.require_columns(df, table)
    return df.select(*[text.blank_to_null(F.col(n)).alias(n) if t == "string" else F.col(n) for n, t in df.dtypes])


def load_lookup_master(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Lookup entries with a whole-number split and dates (S-10)."""
    df = load_dimension(df, "lookup_master")
    typed = {"cm_split": F.col("cm_split").try_cast(numbers.UNIT).try_cast("int")}
    for name in ("last_used", "date_added"):
        if dict(df.dtypes)[name] == "string":
            typed[name] = dates.parse_date(F.col(name), as_of)
    return df.withColumns(typed)


def load_aliases(df: DataFrame) -> dict[str, list[str]]:
    """Header spellings per canonical column (S-14).

    Accepts the long form `(canonical, position, alias)` or the wide form with one column per canonical
    heading. The result is schema metadata, as long as the list of known headings.
    """
    if "alias" not in df.columns:
        headings = df.columns
        df = (df.unpivot([], headings, "canonical", "alias")
              .withColumn("position", F.array_position(F.lit(headings), F.col("canonical"))))
    known = {f.header: f.name for f in schema.MAPPED_FIELDS}
    rows = (df.filter(text.blank_to_null(F.col("alias")).isNotNull())
            .select("canonical", "position", "alias").distinct().orderBy("position", "alias").collect())
    aliases: dict[str, list[str]] = {}
    for row in rows:
        aliases.setdefault(known.get(row.canonical, row.canonical), []).append(row.alias)
    return aliases


def read_exported_lines(df: DataFrame, default_split: bool = True, as_of: dt.date | None = None) -> DataFrame:
    """Lines as text (running, needing fixes, or history) to typed lines (S-6, S-7, S-8).

    Money and numbers are parsed, percentages scaled by the column's own maximum, dates parsed with
    the original text kept in `<col>_raw`, split defaulted, initials and principal upper-cased.
    """
    have = set(df.columns)
    kinds = {f.name: f.kind for f in schema.MAPPED_FIELDS if f.name in have}
    out, percents = {}, []
    for name in df.columns:
        cell = text.blank_to_null(F.col(name).cast("string"))
        kind = kinds.get(name)
        if kind in ("money", "unit"):
            out[name] = numbers.parse_money(cell, schema.TYPE_OF_KIND[kind])
        elif kind == "number" or name == "year":
            out[name] = numbers.parse_number(cell, "int" if name == "year" else "bigint")
        elif kind == "percent":
            out[name] = numbers.parse_percent(cell)
            percents.append(name)
        elif kind == "date" or name in ("paid_date", "sales_report_date", "date_added", "comm_month"):
            source = F.concat(cell, F.lit("-01")) if name == "comm_month" else cell
            out[name] = dates.parse_date(source, as_of)
            out[f"{name}_raw"] = cell
        elif name in ("sales_commission", "cm_sales_comm", "design_sales_comm"):
            out[name] = numbers.parse_money(cell, numbers.SHARE)
        elif name == "cm_split":
            out[name] = numbers.parse_number(cell, "int")
        elif name in ("cm_sales", "design_sales", "principal"):
            out[name] = text.initials(cell)
        else:
            out[name] = cell
    typed = df.select(*[e.alias(n) for n, e in out.items()])
    if percents:
        tops = typed.agg(*[F.max(p).alias(p) for p in percents])
        typed = typed.withColumns(
            {p: numbers.scale_percent(F.col(p), tops.select(p).scalar()) for p in percents})
    if default_split and "cm_split" in have:
        typed = typed.withColumn("cm_split", split_or_default(F.col("cm_split")))
    return typed


def split_or_default(c):
    """Splits of zero or blank mean the standard split (P-10)."""
    return F.coalesce(F.nullif(c, F.lit(0)), F.lit(DEFAULT_SPLIT))


def numeric_sibling(df: DataFrame, columns: list[str]) -> DataFrame:
    """A typed `<col>_num` beside columns that mix text and numbers; identifiers keep their zeros (P-13)."""
    return df.withColumns({f"{c}_num": F.col(c).try_cast(numbers.UNIT) for c in columns if c not in UNTYPED_IDS})


def numeric_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """`numeric_sibling` decided by whole columns: one cell that is no number leaves all of its `_num` blank (P-13).

    All columns are judged in one pass; `evidence.column_types` does so for sheets of any headings.
    """
    columns = [c for c in columns if c not in UNTYPED_IDS]
    if not columns:
        return df
    cells = {c: text.blank_to_null(F.col(c).cast("string")) for c in columns}
    bad = df.agg(*[F.count_if(numbers.unparsed(x, x.try_cast(numbers.UNIT))).alias(c) for c, x in cells.items()])
    return df.withColumns({f"{c}_num": F.when(bad.select(c).scalar() == 0, x.try_cast(numbers.UNIT)) for c, x in cells.items()})
