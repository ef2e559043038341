"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalframe.llm import jaccard, language, mixing, packing, queries, substrings
from shoalframe.llm.storage import materialise, numbered


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language compression can't tell: without a letter, or with a narrow margin."""
    return language.accepted(docs, language.learn(docs, F.lit(True)))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near duplicates; rows without a doc_id stay, rows that share one stay or go together."""
    found = jaccard.near_duplicates(docs)
    return docs.join(found.filter("component_id <> doc_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out the passages that an earlier document has; every document stays, with n_chars of what is left."""
    out = substrings.deduplicate(docs, keep=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: the sources meet their target weights in every stretch of the table."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 ids, placed in sequences; sequences in order of their ids are the mixture, which is the written order of docs."""
    return packing.pack(numbered(docs, "in_mixture"), queries.tokenizer_path(), number="in_mixture")


STAGES = [("language", identify), ("near_duplicates", one_of_each), ("substrings", cut_repeats), ("mixing", mix), ("packing", pack)]

#: SQL can't express compression classification or byte-pair encoding; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage{k}-{name}")
    return docs
