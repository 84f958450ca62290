"""A corpus pipeline of five stages over ``documents``.

Each stage takes what its predecessor has kept, written as Parquet and read again. The first
four return the columns of ``documents``; the last returns the places of the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import contamination, jaccard, langid, lines, packing
from affinity.llm.common import compact, fresh, small, table, workspace
from affinity.llm.tokens import byte_bpe_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language that makes up at least half of them."""
    return compact(langid.reject(docs), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more have; ``n_chars`` follows the text."""
    counts = fresh("lines"), fresh("dropped")
    out = lines.drop_lines(docs, *counts).drop(*counts)
    out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return compact(out, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest doc_id."""
    work = workspace(spark)
    found = jaccard.jaccard_components(docs.select("doc_id", "text"))
    gone = work.write("gone", found.filter("doc_id <> component_id").select("doc_id").distinct())
    return compact(docs.join(small(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth are in windows of benchmark items."""
    return compact(contamination.decontaminate(docs, table(spark, sf_dir, "benchmark")), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2,048 tokens."""
    return packing.pack(docs.select("doc_id", "text"), byte_bpe_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing_stage),
]

# Mixture inference and byte-pair encoding are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.write(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
