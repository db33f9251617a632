"""The queries of this package, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envspark.llm import (alignment, decontaminate, filter_audit, fingerprints, language, mixing, near_dedup,
                          packing, pseudonyms, sharding, substring_dedup, token_counts, url_filter)
from envspark.llm.common import ship, stash


def vocabulary(name: str) -> str:
    """Where the public vocabularies are installed, on the driver and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark, sf_dir):
    found = substring_dedup.deduplicated(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_best_fit_packing(spark, sf_dir):
    return packing.packed(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_minimax_sharding(spark, sf_dir):
    return sharding.sharded(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark, sf_dir):
    return url_filter.judged(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_token_counts(spark, sf_dir):
    return token_counts.counted(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op6_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found, name, score = language.identified(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), F.col(name).alias("lang_pred"),
                        F.col(score).alias("score"))


def op7_decontamination(spark, sf_dir):
    found = decontaminate.hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


#: stands for a key that a deployment keeps in its secret store
KEY = "change-me"


def op8_pii_pseudonyms(spark, sf_dir):
    found, count = pseudonyms.pseudonymized(_table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)
    return found.select("doc_id", "text", F.col(count).alias("n_replaced"))


def op9_minhash_dedup(spark, sf_dir):
    found = near_dedup.components(_table(spark, sf_dir, "documents"), shingle=3, threshold_percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_fingerprints(spark, sf_dir):
    return fingerprints.fingerprinted(_table(spark, sf_dir, "documents"))


def op11_source_mix(spark, sf_dir):
    found, (size, source_size, target, copies) = mixing.mixed(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col(size).alias("size"), F.col(source_size).alias("source_size"),
                        F.col(target).alias("target"), (F.col(size) * F.col(copies)).alias("taken"))


def op12_token_alignment(spark, sf_dir):
    found = alignment.aligned(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                              vocabulary("piece_bpe_32k.model"))
    hashed = F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.lit(""))
    found = alignment.weighed(stash(found.withColumn("groups_sha256", hashed).drop("groups")))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_filter_audit(spark, sf_dir):
    return filter_audit.audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_minimax_sharding": op3_minimax_sharding,
        "op4_url_filter": op4_url_filter,
        "op5_token_counts": op5_token_counts,
        "op6_language_id": op6_language_id,
        "op7_decontamination": op7_decontamination,
        "op8_pii_pseudonyms": op8_pii_pseudonyms,
        "op9_minhash_dedup": op9_minhash_dedup,
        "op10_fingerprints": op10_fingerprints,
        "op11_source_mix": op11_source_mix,
        "op12_token_alignment": op12_token_alignment,
        "op13_filter_audit": op13_filter_audit,
    }
