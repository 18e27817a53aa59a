"""Registered queries of the training-data operators: each ``(spark, sf_dir) -> DataFrame``.

Vocabulary files come with the ``public_tokenizers`` package, which every executor has at one path.
SQL is given where it can express an operator; tests hold the others against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import (
    arc_warc,
    bpe_transducer,
    classifier_chain,
    filter_audit,
    jaccard_tiles,
    line_winnow,
    multi_index,
    pareto_mix,
    prefix_bpe,
    preference,
    quality_bands,
    token_count,
    whitening,
)
from shopfloor.llm.text import documents


def op1_quality_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bands.quality(documents(spark, sf_dir))


def op2_line_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines, how many were deleted and the digest of the text that is left."""
    cut = line_winnow.without_repeats(documents(spark, sf_dir))
    return cut.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_deleted").alias("n_deleted"),
                      F.sha2(F.col("text"), 256).alias("text_sha256"))


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return multi_index.search(vectors, F.col("vec_id") % 100 == 0)


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = preference.format_preferences(preference.swapped_replies(turns))
    return pairs.withColumns({m: preference.mask_text(F.col(m)) for m in ("chosen_mask", "rejected_mask")})


def op6_arc_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_warc.archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tiles.similar_documents(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op8_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classifier_chain.score(docs, classifier_chain.train(docs, labels, classifier_chain.label_categories()))


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix.mix(documents(spark, sf_dir))


def op9_pareto_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rule, under the name that it had beside a shorter one."""
    return pareto_mix.mix(documents(spark, sf_dir))


def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_transducer.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_quality_bands, op2_line_winnow, op3_multi_index, op4_token_count, op5_preference, op6_arc_warc,
    op7_jaccard_tiles, op8_classifier_chain, op9_pareto_mix, op9_pareto_fill, op10_bpe_transducer,
    op11_prefix_bpe, op12_filter_audit, op13_whitening)}

SQL = {"op5_preference": preference.SQL, "op6_arc_warc": arc_warc.SQL, "op9_pareto_mix": pareto_mix.SQL,
       "op9_pareto_fill": pareto_mix.SQL,
       "op12_filter_audit": filter_audit.SQL}
