"""From raw documents to shards of a training corpus, stage by stage.

Each stage takes the documents that the stage before it kept and returns
documents again (the last one with their shard and slot); ``run`` writes every
stage's result as Parquet in the shared folder and reads it back, so a lost
executor costs a task, not the chain.

Defined results: a null or empty text fails the quality rules and goes in the
first stage; of rows that repeat an id and a text one stays after near-dedup;
ties are broken by digests of id and text, so no stage depends on row order;
an empty table gives no rows at any stage; further columns, whatever their
names, pass through all stages (``shard`` and ``slot`` win a clash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontam, order_minhash, quality_rules, sharding
from tidewater.llm.common import read_table, staged
from tidewater.llm.queries import SHARDS, mixed
from tidewater.llm.registry import register


def _own(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a learned rule rejects."""
    rules = quality_rules.learn(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(docs, rules).where(F.col("kept")).select(*_own(docs))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies."""
    return order_minhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights; those of several epochs come several times."""
    return mixed(docs).select(*_own(docs))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``shard`` and ``slot``."""
    return sharding.shard_rows(docs, SHARDS)


STAGES = [("quality rules", quality), ("near-dedup", dedup), ("decontamination", decontaminate),
          ("mixture", mixture), ("sharding", shards)]

#: Learned rules and verified alignments are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


register("pipeline", ORACLE_SQL)(run)
