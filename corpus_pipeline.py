"""Clean a document corpus: quality, exact and near duplicates, benchmark passages, then tokens.

``STAGES`` are ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and re-read as
the next one's ``docs``. All but the last return the columns of ``documents``
and drop rows only; the last adds the token ids of every document that is
left and the text they decode to.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from civicspark.llm import block_naming, circulant_minhash, decontaminate, pair_index_bpe, quality
from civicspark.llm.common import show_package
from civicspark.session import materialize

#: Vocabulary file of the last stage.
TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier finds of low quality or toxic."""
    return quality.drop_low_quality(docs, _table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the largest ``doc_id`` of equal texts (A-Z lower-cased)."""
    return block_naming.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest ``doc_id`` of each group of near duplicates."""
    return circulant_minhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated by benchmark items."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add ``ids``, the tokens of each text, and ``decoded``, the text they give back."""
    return pair_index_bpe.encode_documents(docs, public_tokenizers.path(TOKENIZER), decoded_col="decoded")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _importable(stage: Stage) -> Stage:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        show_package(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    (stage.__name__, _importable(stage)) for stage in (quality_classifier, exact_dedup, near_dedup, benchmark_decontamination, bpe_encoding)
]

#: SQL cannot express the classifier that the first stage fits; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the scratch folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
