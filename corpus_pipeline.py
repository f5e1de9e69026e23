"""The corpus pipeline: STAGES in order, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwatch.llm import line_dedup, quality, queries, simhash
from riskwatch.session import shared_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity band."""
    return quality.judge(docs).where("kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the later occurrences of repeated three-line windows; n_chars follows the text."""
    found = line_dedup.dedup_lines(docs)
    row = F.col("row").withField("text", F.col("text"))
    return found.select(row.withField("n_chars", F.char_length("text").cast("long")).alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class of near-duplicates."""
    return simhash.dedup(docs, shingle=3, distance=2)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents, its digest and its place in a sequence of 4096 tokens."""
    return queries.packed(docs)


STAGES = [("quality", quality_rules), ("lines", lines), ("near_duplicates", near_duplicates), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
