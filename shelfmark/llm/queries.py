"""One query per operator, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import (
    ann,
    chat,
    exact_dedup,
    hard_negatives,
    langid,
    lm_scoring,
    minhash,
    mixing,
    piece_sampling,
    prefix_trie,
    simhash,
    toxicity,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.round_trip(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(_table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame(
        [(-7, 0, "user", chat.PLANTED), (-7, 1, chat.ASSISTANT, chat.PLANTED)],
        "conv_id long, turn long, role string, text string",
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digest(rows.unionByName(planted))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.respun(turns))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_piece_sampling,
        op3_exact_dedup,
        op4_mixing,
        op5_nearest,
        op6_langid,
        op7_chat,
        op8_simhash,
        op9_warc,
        op10_lm_scoring,
        op11_prefix_trie,
        op12_minhash,
        op13_hard_negatives,
    )
}

DEDUP_SQL = """
with texts as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from texts
"""

ORACLES: dict[str, str] = {
    "op3_exact_dedup": DEDUP_SQL,
    "op4_mixing": mixing.MIXING_SQL,
    "op7_chat": chat.CHAT_SQL,
    "op11_prefix_trie": prefix_trie.TRIE_SQL,
    "op12_minhash": minhash.NEAR_SQL,
    "op13_hard_negatives": hard_negatives.NEGATIVES_SQL,
}
