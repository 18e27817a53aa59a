"""From raw documents to a mixed, encoded corpus, in five stages.

Each stage reads all that the one before has kept, written as Parquet; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import bpe_transducer, jaccard_tiles, line_winnow, pareto_mix, quality_bands
from shopfloor.llm.text import documents, saved


#: Of states and of pieces, in each worker: by the last stage the JVM has the most it ever takes. As many states
#: as 64 MB were counted for when they were tuples.
ENCODER_BYTES = (52 << 20, 32 << 20)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and the compression bands."""
    return quality_bands.passing(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that an earlier place has; documents of which nothing is left go."""
    cut = line_winnow.without_repeats(docs)
    cut = cut.where("__n_deleted = 0 or __n_deleted < __n_lines")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        now = F.when(F.col("__n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", now.cast(kind))
    return cut.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return jaccard_tiles.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return pareto_mix.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each row's ids and of the text decoded from them."""
    return bpe_transducer.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), *ENCODER_BYTES)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", encode),
]

#: SQL has neither zstandard nor the vocabulary's merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs)
    return docs
