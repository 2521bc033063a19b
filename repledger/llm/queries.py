"""The queries of the operators over the driver's tables; SQL beside those that SQL can express."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repledger.llm import (alignment, extract, fingerprint, jaccard, language, licences, lm, mixing, packing, quality, search,
                           substrings, tokenfile)
from repledger.llm.common import table, word_count
from repledger.session import remove_at_exit, shared_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


BASE_SQL = """
words as (select r, doc_id, source, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
                 coalesce(text, '') as text from (select row_number() over () as r, * from documents)),
placed as (select r, unnest(w) as x, generate_subscripts(w, 1) as i from words),
windows as (select r, i, string_agg(x, ' ') over (partition by r order by i rows between current row and 7 following) as g,
                   count(*) over (partition by r order by i rows between current row and 7 following) as n from placed),
twice as (select r, i, count(*) over (partition by r, g) as n from windows where n = 8),
covered as (select r, count(distinct i + k) as n_repeat_words
            from (select r, i from twice where n > 1), (select unnest(range(8)) as k) group by r),
lines as (select r, count(x) - count(distinct x) as n_dup_lines
          from (select r, unnest(string_split(text, chr(10))) as x from words)
          where regexp_matches(x, '[^\\x20\\x09-\\x0D]') group by r),
base as (select r, doc_id, source, len(w) as n_words,
                coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
                length(text) - length(translate(text, '#*$%&|<>', '')) as n_symbols,
                coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
         from words left join lines using (r) left join covered using (r)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base)"""

HOST_SQL = f"""
with {BASE_SQL},
hosts as (select source, count(*)::double as n, sum(base_failed::int)::double as x from judged
          where source is not null group by source),
sums as (select sum(n) as n, sum(x) as x, count(*) as h, sum(n * n) as nn, sum(x * x / n) as xx from hosts),
prior as (select x / n as m, (xx - x * x / n - x / n * (1 - x / n) * (h - 1))
                 / nullif(x / n * (1 - x / n) * greatest(n - nn / n - (h - 1), 0), 0) as within from sums),
weight as (select m, case when within > 0 then least({quality.PRIOR_WEIGHT[1]}, greatest({quality.PRIOR_WEIGHT[0]}, 1 / within - 1))
                     else {quality.PRIOR_WEIGHT[1]} end as k from prior),
rates as (select source, n, x, (x + k * m) / (n + k) as rate from hosts, weight)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(rate, 0) <= {quality.HOST_LIMIT} as kept,
       coalesce(n, 0)::bigint as host_docs, coalesce(x, 0)::bigint as host_failed, round(coalesce(rate, 0), 6) as host_rate
from judged left join rates using (source)"""


@query("op1_quality", HOST_SQL)
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "host_docs", "host_failed", F.round("host_rate", 6).alias("host_rate"))


@query("op4_licences", licences.oracle())
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("line_licenses", F.array_join("line_licenses", " "))


@query("op2_substrings")
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed",
                        F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query("op3_main_text")
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_jaccard")
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.alike(table(spark, sf_dir, "documents"))


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~language.held_out()))
    found = language.identify(docs, model)
    return found.select("doc_id", F.coalesce(language.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op7_pack")
def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@query("op8_fingerprint")
def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_likeness(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next")


@query("op9_mix")
def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.array("source").alias("sources"), word_count().alias("size"))
    return mixing.mix(docs).select("doc_id", "size", F.col("source_sizes")[0].alias("source_size"),
                                   F.col("targets")[0].alias("target"), F.col("taken").cast("long").alias("taken"))


@query("op10_token_file")
def op10_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = remove_at_exit(spark, f"{shared_folder(spark)}/llm-tokenfile-{uuid.uuid4().hex}")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_file())
    return tokenfile.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op11_search", search.SEARCH_SQL)
def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_score")
def op12_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, model = lm.fit_and_score(docs)
    return found.select("doc_id", lm.held_out().alias("held_out"), "n_tokens", "n_known",
                        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query("op13_align")
def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
