"""Matching lines against lookups, distributors, accounts and people (J-1..J-10, J-16).

Dimensions are reduced to one row per key, with the number of matches, before they meet the lines, so
no join can multiply lines. No side is forced to be broadcast: Spark broadcasts a side whose measured
size allows it and otherwise shuffles, splitting skewed partitions of the lines at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repledger.functions import text
from repledger.sources.readers import DEFAULT_SPLIT

LOOKUP_FIELDS = ("cm_sales", "design_sales", "t_name", "cm", "t_end_cust", "cm_split")
CORRECTION = "correction"
NEAR_CITY_PREFIX = "OOT"


def one_per_key(dim: DataFrame, keys: list[str], values: list[str], order: Column | None = None,
                count_as: str = "n") -> DataFrame:
    """`keys`, the number of rows behind them and the values of the first row in `order`."""
    packed = F.struct(*values)
    first = F.min_by(packed, order) if order is not None else F.max(packed)
    return (dim.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as), first.alias("_v"))
            .select(*keys, count_as, *[F.col("_v")[v].alias(v) for v in values]))


# --- lookup master -----------------------------------------------------------------------------------

def _keyed_lookup(lookup: DataFrame) -> DataFrame:
    return lookup.withColumns({"_cust": text.fold(F.col("reported_customer")),
                               "_part": text.fold(F.col("part_number"))})


def lookup_options(lookup: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Per key and field the distinct values in first-seen order, joined by `', '` (J-3).

    Values are made distinct by a plain aggregation first; what is finally collected per key is only
    the text that the result shows.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("")).alias("value"))
        for f in LOOKUP_FIELDS]))
    seen = (lookup.select(*keys, order.alias("_o"), cells.alias("_c"))
            .groupBy(*keys, F.col("_c.field").alias("_f"), F.col("_c.value").alias("_t"))
            .agg(F.min("_o").alias("_o")))

    def joined(field):
        of_field = F.collect_list(F.when(F.col("_f") == field, F.struct("_o", "_t")))
        return F.array_join(F.transform(F.array_sort(of_field), lambda x: x["_t"]), ", ").alias(f"_all_{field}")

    return seen.groupBy(*keys).agg(*[joined(f) for f in LOOKUP_FIELDS])


def lookup_index(lookup: DataFrame, order: Column, with_options: bool = True) -> DataFrame:
    """The lookup master as one row per (customer, part): `_n`, `_v` (values when `_n` = 1) and joined options."""
    keys = ["_cust", "_part"]
    keyed = _keyed_lookup(lookup)
    index = keyed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.struct(*LOOKUP_FIELDS, "lookup_id", "city")).alias("_v"))
    if not with_options:
        return index
    several = index.filter("_n > 1").select(*keys)
    options = lookup_options(keyed.join(several, keys, "left_semi"), keys, order)
    return index.join(options, keys, "left")


def match_lookup(lines: DataFrame, lookup: DataFrame, order: Column, with_options: bool = True) -> DataFrame:
    """Match lines on customer and part, ignoring case, blanks matching blanks (J-1..J-3, F-7).

    Adds `found` (lookup rows behind the key), `lookup_matches` (0 for correction lines and for soft matches,
    that is single matches naming no salesperson) and `lookup_id` for single matches. Single matches
    take the lookup's values, several matches show every distinct value; other lines keep their own.
    `cm_split` stays numeric, so its options stand in `cm_split_options`.
    """
    index = lookup_index(lookup, order, with_options)
    is_correction = F.contains(F.lower(F.coalesce(F.col("t_notes"), F.lit(""))), F.lit(CORRECTION))
    keyed = lines.withColumns({
        "_cust": F.when(~is_correction, text.fold(F.col("reported_customer"))),
        "_part": text.fold(F.col("part_number"))})
    joined = keyed.join(index, ["_cust", "_part"], "left")
    n = F.coalesce(F.col("_n"), F.lit(0))
    single = n == 1
    soft = F.col("_v.cm_sales").isNull() & F.col("_v.design_sales").isNull()
    out = {}
    for f in LOOKUP_FIELDS:
        own = F.col(f) if f in lines.columns else F.lit(None)
        value = F.when(single, F.col(f"_v.{f}"))
        if with_options and f != "cm_split":
            value = value.when(n > 1, F.col(f"_all_{f}"))
        out[f] = value.otherwise(own)
    if with_options:
        out["cm_split_options"] = F.when(n > 1, F.col("_all_cm_split"))
    out["found"] = n
    out["lookup_matches"] = F.when(single & soft, F.lit(0)).otherwise(n).cast("bigint")
    out["lookup_id"] = F.when(single, F.col("_v.lookup_id"))
    helpers = ["_cust", "_part", *[c for c in index.columns if c.startswith("_")]]
    return joined.withColumns(out).drop(*helpers)


def lookup_usage(matched: DataFrame, lookup: DataFrame, as_of, line_order: Column) -> DataFrame:
    """The lookup master after a run: single matches were used on `as_of`, blank out-of-territory cities are
    filled from the first line that names one (J-16)."""
    used = (matched.filter(F.col("lookup_id").isNotNull())
            .groupBy("lookup_id")
            .agg(F.min_by(F.col("city"), F.when(F.col("city").isNotNull(), line_order)).alias("_city")))
    joined = lookup.join(used.withColumn("_used", F.lit(True)), "lookup_id", "left")
    hit = F.coalesce(F.col("_used"), F.lit(False))
    fills = hit & F.col("city").isNull() & F.startswith(F.col("t_name"), F.lit(NEAR_CITY_PREFIX))
    return joined.withColumns({
        "last_used": F.when(hit, F.lit(as_of)).otherwise(F.col("last_used")),
        "city": F.when(fills, F.col("_city")).otherwise(F.col("city")),
    }).drop("_city", "_used")


# --- distributors ------------------------------------------------------------------------------------

def distributor_hits(names: DataFrame, distributor_map: DataFrame, name: str = "name") -> DataFrame:
    """Per distinct name: how many abbreviations it contains, and the corrected name if exactly one (J-4).

    Containment is an equality join: every substring with the length of some abbreviation is looked up.
    The list of lengths is one small array however many abbreviations there are.
    """
    known = distributor_map.filter(F.length("search_abbreviation") > 0)
    lengths = known.agg(F.array_sort(F.collect_set(F.length("search_abbreviation"))).alias("ls")).scalar()
    distinct = names.select(F.col(name).alias("name")).distinct()
    cleaned = distinct.withColumn("clean", F.coalesce(text.alnum_lower(F.col("name")), F.lit("")))
    sized = (cleaned.select("name", "clean", F.explode(lengths).alias("size"))
             .filter(F.col("size") <= F.length("clean")))
    pieces = F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length("clean") - F.col("size") + 1),
        lambda start: F.substring(F.col("clean"), start, F.col("size"))))
    found = (sized.select("name", F.explode(pieces).alias("piece"))
             .join(known.select(F.col("search_abbreviation").alias("piece"), "corrected_dist"), "piece")
             .groupBy("name").agg(F.count(F.lit(1)).alias("hits"), F.max("corrected_dist").alias("corrected")))
    return found.withColumn("corrected", F.when(F.col("hits") == 1, F.col("corrected")))


def match_distributor(lines: DataFrame, distributor_map: DataFrame, name: str = "reported_distributor") -> DataFrame:
    """Adds `distributor_matches` and sets `distributor` on exactly one hit; a blank name counts as matched (J-4)."""
    hits = distributor_hits(lines, distributor_map, name).withColumnRenamed("name", name)
    spread = text.key_or_spread(F.col(name), lines.columns)
    joined = lines.withColumn("_key", spread).join(hits.withColumnRenamed(name, "_key"), "_key", "left").drop("_key")
    own = F.col("distributor") if "distributor" in lines.columns else F.lit(None).cast("string")
    blank = F.coalesce(F.length(text.alnum_lower(F.col(name))), F.lit(0)) == 0
    return joined.withColumns({
        "distributor": F.when(blank, None).otherwise(F.coalesce(F.col("corrected"), own)),
        "distributor_matches": F.when(blank, 1).otherwise(F.coalesce(F.col("hits"), F.lit(0))).cast("bigint"),
    }).drop("hits", "corrected").select(*lines.columns, *[c for c in ("distributor", "distributor_matches")
                                                          if c not in lines.columns])


# --- accounts and people -----------------------------------------------------------------------------

def tag_current_design_sales(lines: DataFrame, accounts: DataFrame) -> DataFrame:
    """`cds`: the salesperson of the only account of that exact name, else design sales, else CM sales (J-8, C-7)."""
    unique = (one_per_key(accounts.filter(F.col("proper_name").isNotNull()), ["proper_name"], ["sls"], count_as="_n")
              .filter("_n = 1").select(F.col("proper_name").alias("t_end_cust"), F.col("sls").alias("_sls"),
                                       F.lit(True).alias("_acct")))
    spread = text.key_or_spread(F.col("t_end_cust"), lines.columns)
    joined = lines.withColumn("_key", spread).join(unique.withColumnRenamed("t_end_cust", "_key"), "_key", "left").drop("_key")
    fallback = F.coalesce("design_sales", "cm_sales")
    return joined.withColumn("cds", F.when(F.col("_acct"), F.col("_sls")).otherwise(fallback)).drop("_sls", "_acct")


def person_rates(salespeople: DataFrame) -> DataFrame:
    """One rate per initials (first row wins on repeats)."""
    known = salespeople.filter(F.col("sales_initials").isNotNull())
    order = F.struct("salesperson", "sales_percentage")
    return one_per_key(known, ["sales_initials"], ["sales_percentage", "qq_split", "salesperson"], order)


def attach_rates(lines: DataFrame, salespeople: DataFrame) -> DataFrame:
    """`cm_pct` and `design_pct`: the percentages of the two people on a line (J-10)."""
    rates = person_rates(salespeople)
    cm = rates.select(F.col("sales_initials").alias("cm_sales"), F.col("sales_percentage").alias("cm_pct"))
    design = rates.select(F.col("sales_initials").alias("design_sales"), F.col("sales_percentage").alias("design_pct"))
    return lines.join(cm, "cm_sales", "left").join(design, "design_sales", "left")


# --- re-linking entries that lost their id -----------------------------------------------------------

LINK_KEYS = ("reported_customer", "part_number", "from_file")
FIVE = ("_customer", "_part", "_file", "_paid", "_invoice")
FOUR = FIVE[:4]


def _link_keyed(df: DataFrame) -> DataFrame:
    """Ids with 16 bytes for the four keys, 16 for the five, and the 32 of the group's name.

    Keys are moved and compared as digests. A key is preceded by its length, so no two lists of keys are one text.
    """
    def digest(keys):
        return F.unhex(F.md5(F.concat(*[x for k in keys for x in (F.length(k).cast("string"), F.lit(":"), F.col(k))])))

    paid = F.round(F.coalesce(F.col("actual_comm_paid"), F.lit(0)), 2).cast("decimal(18,2)").cast("string")
    values = [*[text.same_or_blank(F.col(c)) for c in LINK_KEYS], paid, text.same_or_blank(F.col("invoice_number"))]
    keyed = df.select("unique_id", *[v.alias(k) for v, k in zip(values, FIVE)])
    return keyed.select("unique_id", digest(FOUR).alias("_four"), digest(FIVE).alias("_five"), _group_of().alias("_name"))


def _group_of() -> Column:
    """The name of a group of lines that are alike in all five keys."""
    four = F.sha2(F.concat_ws("\u0001", *FOUR), 256)
    return F.unhex(F.sha2(F.concat_ws("\u0001", four, FIVE[-1]), 256))


def relink(entries: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Find the running lines of entries by customer, part, file and commission; on ties also by invoice (J-9).

    Returns `links`, one row per entry with the number of lines it matches, the line's id when it is one,
    the `match_group` it claims and whether another entry claims the same, and `members`, the ids in each
    claimed group of several. The two stay apart because listing a group's lines on each of its entries would grow with
    the square of the group.

    Entries and lines alike in all five keys are one row after the first aggregation. All that an entry gets is worked out
    on these rows, so the entries themselves are dealt once.
    """
    ours, theirs = _link_keyed(entries), _link_keyed(lines)
    none = F.lit(None).cast("string")
    both = theirs.select("_four", "_five", F.col("unique_id").alias("_id"), F.lit(1).alias("_line")).unionByName(
        ours.select("_four", "_five", none.alias("_id"), F.lit(0).alias("_line")))
    groups = both.groupBy("_five").agg(
        F.any_value("_four").alias("_four"), F.sum("_line").alias("_n5"), F.min("_id").alias("_id5"),
        F.count_if(F.col("_line") == 0).alias("_entries"))
    alike, n4, n5 = Window.partitionBy("_four"), F.col("_n4"), F.col("_n5")
    known = groups.select("_five", "_n5", "_id5", "_entries", F.sum("_n5").over(alike).alias("_n4"),
                          F.min("_id5").over(alike).alias("_id4")).filter("_entries > 0")
    # What is claimed is a line's id or the group; where nothing is, keys of their own keep the rows apart.
    claimed = F.when(n4 == 1, F.col("_id4")).when((n4 > 1) & (n5 > 0), F.hex("_five"))
    same = Window.partitionBy(F.coalesce(claimed, F.concat(F.lit("\u0001"), F.hex("_five"))))
    found = known.select(
        "_five", F.when(n4 <= 1, n4).otherwise(n5).cast("bigint").alias("n_matches"),
        F.when(n4 == 1, F.col("_id4")).when((n4 > 1) & (n5 == 1), F.col("_id5")).alias("line_id"),
        (n4 == 1).alias("_by_line"), ((n4 > 1) & (n5 > 0)).alias("_by_group"),
        F.when(claimed.isNotNull(), F.sum("_entries").over(same)).otherwise(F.lit(0)).alias("n_claims"))
    claim = F.when(F.col("_by_line"), F.col("line_id")).when(F.col("_by_group"), F.lower(F.hex("_name")))
    links = ours.join(found, "_five", "left").select(
        F.col("unique_id").alias("entry_id"), "n_matches", "line_id", claim.alias("claim"), "n_claims",
        (F.col("n_claims") > 1).alias("collides"))
    several = groups.filter("_entries > 0 and _n5 > 1").select("_five")
    members = theirs.join(several, "_five", "left_semi").select(
        F.lower(F.hex("_name")).alias("claim"), F.col("unique_id").alias("line_id"))
    return links, members
