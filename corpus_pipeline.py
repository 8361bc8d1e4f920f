"""From raw documents to a sharded training corpus, as stages that are each written and read again.

1. Toxicity: documents that score 0.3 or more by their nearest labelled examples go.
2. Near-duplicates: of each class by ProbMinHash, the document of the least id stays.
3. Decontamination: documents with a passage that aligns with a benchmark item go.
4. Mixture: sources are brought to their target weights; a row comes as often as the mix takes it.
5. Sharding: rows get one of 16 shards of equal bytes, moved as little as possible, and a slot in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, mixture, probminhash, reshard, toxicity
from quarry.llm.common import stored
from quarry.llm.queries import table


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return probminhash.keep_one(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def _mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mixed_rows(docs, odds_weight=F.log2(F.col("size") + 2))


def _sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return reshard.reshard(docs)


STAGES = [
    ("toxicity", _toxicity),
    ("near_duplicates", _near_duplicates),
    ("decontamination", _decontaminate),
    ("mixture", _mixture),
    ("sharding", _sharding),
]

#: Several stages (nearest neighbours, sketches, alignment, flow) cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
