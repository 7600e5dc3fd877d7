"""The registered queries of the text operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import bpe, chat, exact_dedup, near_dedup, nearest, packing, pii, repeats, token_counts, toxicity
from helixframe.llm.common import load


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(load(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(load(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(load(spark, sf_dir, "documents"), num=85)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").selectExpr("conv_id", "CAST(turn AS LONG) AS turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(turns.union(extra)))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 1024, with_ids=False)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(load(spark, sf_dir, "embeddings"), every=20, k=20)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(load(spark, sf_dir, "documents"), 400)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 2048)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_pii, op2_exact_dedup, op3_bpe, op4_near_dedup, op5_chat, op6_packing, op7_toxicity, op8_nearest, op9_repeats, op10_token_counts)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.SQL, "op4_near_dedup": near_dedup.SQL, "op5_chat": chat.SQL, "op8_nearest": nearest.SQL, "op9_repeats": repeats.SQL}
