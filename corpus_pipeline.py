"""A cleaning pipeline over ``documents``: classify, dedup lines, dedup documents, mix, pack.

Every stage takes what its predecessor kept and its decisions take effect. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodgegrid.llm.jaccard_forest import keep_one
from lodgegrid.llm.line_runs import without_repeated_lines
from lodgegrid.llm.mixing import mix, mixed_texts
from lodgegrid.llm.packing import pack
from lodgegrid.llm.qda import keep_good
from lodgegrid.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the smallest ``doc_id`` only."""
    return without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of the sources in their target shares, a row per run of words taken in a pass."""
    spans, _ = mix(docs)
    return mixed_texts(docs, spans)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the mix in sequences."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing", mixture),
    ("packing", packing),
]

# No SQL has the classifier's Cholesky factors, MinHash, the permutations or the tokenizer; the stages
# are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
