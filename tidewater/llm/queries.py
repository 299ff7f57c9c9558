"""The registered queries of the corpus operators: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (chat, conversation_repair, decontam, hard_negatives, langid, mixing, order_minhash, pu_quality,
                           quality_rules, sharding, suffix_dedup, token_counts, token_files)
from tidewater.llm.common import documents, read_table, staged
from tidewater.llm.registry import QUERIES, register  # noqa: F401

#: Domains of the corpus's sources (the number in a source's name) and the mixture's weights.
DOMAINS = ("web", "news", "books", "forum")
WEIGHTS = {"domain": {"web": 40, "news": 25, "books": 20, "forum": 15}, "lang": {"en": 50, "fr": 20, "de": 20, "es": 10}}
BUDGET_PCT, MAX_EPOCHS, SHARDS = 60, 4, 24


def id_hash(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string"))


def domain_of(source: str = "source"):
    number = F.coalesce(F.try_to_number(F.regexp_extract(source, r"(\d+)$", 1), F.lit("999999999")).cast("long"), F.lit(0))
    return F.get(F.array(*[F.lit(d) for d in DOMAINS]), F.pmod(number, F.lit(len(DOMAINS))).cast("int"))


@register("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = documents(spark, sf_dir, "doc_id", "text")
    rules = quality_rules.learn(df, read_table(spark, sf_dir, "labels"))
    return quality_rules.apply_rules(df, rules).drop("text")


@register("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, held = documents(spark, sf_dir, "doc_id", "text"), F.coalesce(id_hash() % 5 == 0, F.lit(False))
    model = pu_quality.learn(df.where(~held), read_table(spark, sf_dir, "labels").where(~held))
    return (pu_quality.score(df, model).withColumn("held_out", held)
            .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


@register("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.histogram(documents(spark, sf_dir, "text"))


@register("op4_chat_formatting", chat.ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(read_table(spark, sf_dir, "conversations"))


@register("op5_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(documents(spark, sf_dir, "doc_id", "text"), read_table(spark, sf_dir, "benchmark")).drop("k1", "k2")


def mixed(df: DataFrame, **columns) -> DataFrame:
    return mixing.mix(df, domain_of(), WEIGHTS, BUDGET_PCT, MAX_EPOCHS, **columns)


_NUMBER_SQL = "regexp_extract(source, '(\\d+)$', 1)"
DOMAIN_SQL = (f"[{', '.join(repr(d) for d in DOMAINS)}][1 + CASE WHEN length({_NUMBER_SQL}) BETWEEN 1 AND 9 "
              f"THEN CAST({_NUMBER_SQL} AS BIGINT) ELSE 0 END % {len(DOMAINS)}]")


@register("op6_mixing", mixing.oracle(DOMAIN_SQL, WEIGHTS, BUDGET_PCT, MAX_EPOCHS))
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = documents(spark, sf_dir, "doc_id", "text", "lang", "source")
    slim = staged(df.select("doc_id", "lang", "source", mixing.token_count(F.col("text")).alias("tokens"),
                            F.md5(F.coalesce("text", F.lit(""))).alias("digest")), "mix-input")
    return mixed(slim, tokens=F.col("tokens"), digest=F.col("digest")).drop("tokens", "digest")


@register("op7_order_minhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, _ = order_minhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "class_size", "class_rows", "is_first", "class_links")


@register("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, held = documents(spark, sf_dir, "doc_id", "text", "lang"), F.coalesce(id_hash() % 3 == 1, F.lit(False))
    return langid.identify(df, df.where(~held)).withColumn("held_out", held)


@register("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    df = documents(spark, sf_dir, "doc_id", "text", "source")
    slim = staged(df.select("doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")), "shard-input")
    out = sharding.shard_rows(slim, SHARDS, text_digest=F.col("text_crc32"))
    return (out.drop("source").withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int")))


@register("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.checksums(token_files.round_trip(documents(spark, sf_dir, "doc_id", "text")))


@register("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_and_repair(read_table(spark, sf_dir, "conversations"))


@register("op12_hard_negatives", hard_negatives.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=moved)


@register("op13_suffix_dedup", suffix_dedup.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.dedup_substrings(documents(spark, sf_dir, "doc_id", "text")))
