"""From raw documents to packed sequences: quality, near duplicates, personal data, mixture, packing.

Each stage takes what the one before kept, written as Parquet and read again. All but the last
return rows of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmart.llm import mixing, neardup, packing, pseudonyms, quality
from spendmart.llm.common import compactly_staged, free_name, table
from spendmart.llm.queries import SAMPLE_KEY
from spendmart.llm.shipping import ship

#: Session setting with the key of the pseudonyms, which whoever holds it can invert. Without it the
#: key of the samples is used, which is public.
KEY_SETTING = "spark.spendmart.pseudonymKey"
#: Words a tokenizing worker remembers during a task. Other stages run in the same workers.
WORD_MEMORY = 150_000

#: The forests and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    name = free_name(docs, "judged")
    judged = quality.judged(docs, table(spark, sf_dir, "labels"), name=name)
    return judged.where(F.col(name)["kept"]).drop(name)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows are linked, not ids: only a row whose own text is confirmed goes.
    """
    ship(spark)
    return neardup.without_near_duplicates(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    key = spark.conf.get(KEY_SETTING, None)
    return pseudonyms.with_pseudonyms(docs, key.encode() if key else SAMPLE_KEY).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    name = free_name(docs, "mix")
    return mixing.mix(docs, name=name).drop(name)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, word_memory=WORD_MEMORY, words_last=False)


STAGES = [
    ("quality_rules", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("pseudonyms", hide_personal_data),
    ("source_mixture", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = compactly_staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
