"""Operator 1: rules on each document, failures by host, rates shrunk by an empirical beta prior, and host verdicts.

Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repledger.llm.common import WHITE, WORD, stage

#: Rules on a document: least words, and most per cent of words in repeated windows of so many words.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
#: A host whose shrunk rate of failures is above this is turned away with all its documents.
HOST_LIMIT = 0.5
#: Bounds of the prior's weight, in documents: at least one, and a finite number where hosts don't differ.
PRIOR_WEIGHT = (1.0, 1e6)
#: Rows of a host are dealt to so many tasks when its verdict comes back to them.
SALTS = 32


def _let(value: Column, fn) -> Column:
    """fn(value) with the value computed once, however often fn uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def repeated_words(text: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of `window` words found twice or more in the text.

    Windows are told apart by a 64-bit hash. Their hashes are sorted with their places: equal neighbours are repeats;
    the places of these in ascending order then give the words that they cover.
    """
    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (F.get(s, k + 1)["h"] == x["h"]) | (F.get(s, k - 1)["h"] == x["h"]))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def spread(p: Column) -> Column:
            new = F.transform(p, lambda x, k: F.least(F.lit(window), x - F.get(p, k - 1)))
            return F.aggregate(new, F.lit(0), lambda a, x: a + x)

        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, _let(_let(placed, places), spread)).otherwise(F.lit(0))

    def hashes(w: Column) -> Column:
        n = F.size(w) - window + 1
        return F.when(n > 1, F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(w, i, window)))).otherwise(
            F.array().cast("array<bigint>"))

    return _let(_let(words(text), hashes), covered)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, source) and the base measures of each row; null text has no word."""
    body = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(body, WHITE, "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    repeated_lines = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    df = docs.select(
        "doc_id", "source",
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeated_lines.cast("long").alias("n_dup_lines"),
        repeated_words(body).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def host_rates(hosts: DataFrame) -> DataFrame:
    """(source, n_docs, n_failed, host_rate) from counts by host, with a beta prior that the hosts themselves give.

    The prior's mean is the share of failures over all documents. Its weight comes from the hosts' spread about that
    mean beyond what chance gives (the moment estimate of the correlation within hosts), and is held within bounds.
    """
    # Squares of counts do not fit a long: they are computed as doubles.
    n, x, total = F.col("n_docs").cast("double"), F.col("n_failed").cast("double"), F.sum
    sums = hosts.agg(total(n).alias("n"), total(x).alias("x"), F.count("*").alias("h"),
                     total(n * n).alias("nn"),
                     total(x * x / n).alias("xx")).first()
    if not sums["n"]:
        return hosts.withColumn("host_rate", F.lit(0.0))
    mean = sums["x"] / sums["n"]
    chance = mean * (1 - mean)
    spread = sums["xx"] - sums["x"] * mean  # of the hosts' rates about the mean, weighted by documents
    room = sums["n"] - sums["nn"] / sums["n"] - (sums["h"] - 1)
    within = (spread - chance * (sums["h"] - 1)) / (chance * room) if chance > 0 and room > 0 else 0.0
    least, most = PRIOR_WEIGHT
    weight = min(most, max(least, 1 / within - 1)) if within > 0 else most
    return hosts.withColumn("host_rate", (x + F.lit(weight * mean)) / (n + F.lit(weight)))


def judge(docs: DataFrame, limit: float = HOST_LIMIT, name: str = "quality") -> DataFrame:
    """The measures of every row, with base_failed, host_docs, host_failed, host_rate and kept.

    kept is false where the document fails by itself or its host's shrunk rate of failures is above `limit`. Null text
    has no word and fails. A null source is no host: its documents stand by themselves. Repeated and null ids stay,
    each counted for its host; an empty table gives no row. Other columns are left out.

    Texts are read once: the measures are staged, then counted by host and joined with the verdicts. A host's counts
    are summed before they are shuffled, and its rows are dealt to `SALTS` tasks for the join.
    """
    rows = stage(measures(docs), name)
    hosts = rows.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rates = host_rates(hosts).select(
        F.col("source").alias("host"), F.col("n_docs").alias("host_docs"), F.col("n_failed").alias("host_failed"),
        "host_rate", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("host_salt"))
    salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
    known = rows.where(F.col("source").isNotNull()).withColumn("salt", salt)
    known = known.join(rates, (F.col("source") == F.col("host")) & (F.col("salt") == F.col("host_salt")), "left")
    none = rows.where(F.col("source").isNull()).withColumns(
        {"host_docs": F.lit(0).cast("long"), "host_failed": F.lit(0).cast("long"), "host_rate": F.lit(0.0)})
    out = known.drop("salt", "host", "host_salt").unionByName(none)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= limit))
