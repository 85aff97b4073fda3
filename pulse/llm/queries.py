"""The registered queries of the corpus operators and, where SQL can say it, their SQL.

Each query applies its operator with production parameters to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm import bpe, decontaminate, fertility, html_density, langid, licenses, line_dedup, lloyd, quality_mil, secret_scan, simhash, spelling, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return add


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def bpe_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


PIECES = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"


@query("op7_bpe_prefix")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary(RANKS), bpe_pattern())


@query("op10_fertility_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fertility.quality_rules(table(spark, sf_dir, "documents"), vocabulary(PIECES))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                       "lang", "script", "n_tokens", "chars_per_token", "byte_share", "entropy")


@query("op6_simhash_trie")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_text_density")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract(table(spark, sf_dir, "pages"))


@query("op3_hyperdimensional_langid")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op8_warc_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(spark, warc.write(table(spark, sf_dir, "pages"))).drop("url")


@query("op1_line_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines before and after, the numbers of the lines that went, digest of the text left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed",
        F.length("text").cast("long").alias("n_chars_left"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query("op5_cgk_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of a document and a benchmark item found in it."""
    return decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_license_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


ORACLE_SQL["op9_license_rules"] = licenses.scan_sql()


@query("op4_attention_mil_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_resident_lloyd")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.compress(table(spark, sf_dir, "embeddings")).drop("label")


@query("op12_markov_secrets")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query("op13_bloom_spelling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
