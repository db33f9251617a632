"""A corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and is
written as Parquet before the next one reads it. All but the last return the columns of
`documents`. Equal rows, nulls and empty texts are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envspark.llm import decontaminate, language, near_dedup, packing, pseudonyms
from envspark.llm.common import ship, stash
from envspark.llm.queries import KEY, vocabulary


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters and those that no learned language claims go; mixtures of learned languages stay."""
    ship(spark)
    return language.claimed(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    ship(spark)
    return near_dedup.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    ship(spark)
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; n_chars follows the new text."""
    found, _ = pseudonyms.pseudonymized(docs, KEY)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of the rest."""
    ship(spark)
    return packing.packed(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("packing", pack),
]

#: language ID and packing have no SQL equivalent
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, stash(docs) if number else docs, sf_dir)
    return docs
