"""The corpus pipeline: quality rules, near duplicates, benchmark passages, personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's rows as Parquet to the
shared folder and reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm import bpe, decontam, jaccard, pii, quality
from snapledger.llm._util import stored, table
from snapledger.llm.queries import KEY, PATTERN, RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a rule rejects; null and empty texts go with the shortest."""
    return quality.filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by word 5-grams at a similarity of 0.8: the least id.

    Rows are numbered and written first. Of rows with the same id and text one stays; which one, if other
    columns differ, is left open. Texts without words are linked with nothing and all stay. Only the
    numbers of the rows that are left out go through the join.
    """
    rows = stored(docs.select(F.monotonically_increasing_id().alias("u"), F.struct(*docs.columns).alias("row")), "numbered")
    texts = rows.select("u", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    out = jaccard.linked(texts, n=5, per_cent=80, row_col="u").where("NOT kept").select(F.col("row").alias("u"))
    return rows.join(out, "u", "left_anti").select("row.*")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out spans that match a test item; drops documents more than half covered."""
    return decontam.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts that are left by surrogates."""
    columns = docs.columns
    return pii.replace(docs.select(F.struct(*columns).alias("row"), "doc_id", "text"), KEY).select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left and proves the round trip: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: Byte-level BPE and keyed surrogates are beyond SQL; tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
