"""The corpus pipeline: documents through five stages, in this order.

1. language_id      drops documents in no language that the labelled rows teach
2. near_dedup       keeps the first document of each near-duplicate group
3. substring_dedup  removes sentences of repeated runs from the texts
4. decontamination  drops documents with a twentieth of their words, or more,
                    in benchmark phrases
5. piece_encoding   SentencePiece ids of each text, and what they decode to

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all
but the last return the columns of ``documents``. The last returns doc_id,
lang, source, n_tokens, ids (array<int>), ids_sha256 and decoded_sha256.

Defined results: an empty table passes through; null texts have no language and
go in stage 1; repeated rows are near duplicates of each other, one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from intake_spark.llm import decontam, langid, piece_codec, substring_dedup, weighted_minhash
from intake_spark.llm.files import stored
from intake_spark.llm.queries import table, tokenizer_path
from intake_spark.llm.ship import ship


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return langid.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return weighted_minhash.clean(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return substring_dedup.clean(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return piece_codec.encode_documents(docs, tokenizer_path("piece_bpe_32k.model"), with_ids=True,
                                        keep=["lang", "source"])


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination),
    ("piece_encoding", piece_encoding),
]
#: A learned model and a tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
