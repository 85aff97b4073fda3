"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, decontamination, BPE encoding.

Every stage works on all rows its predecessor kept and passes the columns of documents on (the last one
returns the encoded documents). Stages are written as Parquet in the shared folder and read again, so a lost
executor costs a stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm import bpe, decontaminate, fertility, line_dedup, simhash
from pulse.llm.common import written
from pulse.llm.queries import PIECES, RANKS, bpe_pattern, table, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return fertility.keep(docs, vocabulary(PIECES))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; n_chars follows. A document that lost lines and has only blank
    ones left goes too: all it said stands in earlier documents."""
    rows = line_dedup.dedup_lines(docs)
    rows = rows.where(~((F.size("removed") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size("removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest doc_id."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, encoded: token ids, and digests of the ids and of the bytes decoded
    from them."""
    return bpe.encode_decode(docs, vocabulary(RANKS), bpe_pattern(), with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_bpe),
]

# SQL has no tokenisers, tries or random walks; the stages are tested against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k}")
    return docs
