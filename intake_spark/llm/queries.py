"""Registered queries of the operators in this package, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    collocations,
    cross_align,
    decontam,
    embed_dedup,
    id_store,
    langid,
    mixing,
    oracle,
    piece_codec,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filter,
    weighted_minhash,
)
from .ship import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` without the sentences of repeated runs."""
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` as pieces, and decoded again."""
    return piece_codec.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``."""
    return langid.predict(table(spark, sf_dir, "documents"))


def op4_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` written as token-id shards and read back by key."""
    docs = table(spark, sf_dir, "documents")
    return id_store.store_digest(docs, scratch_path(spark, "ids"), tokenizer_path("byte_bpe_50k.json"))


def op5_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all ``embeddings`` with cosine 0.95 or more."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``, learned from ``labels``."""
    return toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The rules that op7 applies: verdict, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document of ``documents``."""
    return weighted_minhash.digest(table(spark, sf_dir, "documents"))


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of whole ``documents`` that lie in occurrences of ``benchmark`` phrases."""
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of whole ``documents`` in repeated strings of 100 bytes."""
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document of ``documents`` a mix of the sources takes."""
    return mixing.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of each language of ``documents`` by collocation score."""
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' ids of every whole text of ``documents`` line up."""
    return cross_align.digest(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                              tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_piece_codec": op2_piece_codec,
    "op3_langid": op3_langid,
    "op4_id_store": op4_id_store,
    "op5_embed_dedup": op5_embed_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_weighted_minhash": op8_weighted_minhash,
    "op9_decontam": op9_decontam,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_mixing": op11_mixing,
    "op12_collocations": op12_collocations,
    "op13_cross_align": op13_cross_align,
}
ORACLE: dict[str, str] = {
    "op1_substring_dedup": oracle.OP1,
    "op5_embed_dedup": oracle.OP5,
    "op7_url_filter": oracle.op7(URL_RULES),
    "op9_decontam": oracle.op9(),
    "op11_mixing": oracle.op11(),
    "op12_collocations": oracle.op12(),
}
