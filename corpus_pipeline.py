"""From raw documents to packed token sequences, stage by stage.

Every stage takes all rows its predecessor kept and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each result as Parquet below the shared folder and reads it
back, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewheel.llm import decontam, jaccard, packing, pii, rules
from tidewheel.session import fresh_dir
from tidewheel.sources.readers import read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fitted cutoffs."""
    return rules.kept(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts linked at a similarity of 0.75."""
    return jaccard.deduplicated(docs, percent=75)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, verbatim or with other slot values."""
    return decontam.cleaned(docs, read_table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in the text."""
    return pii.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and places in sequences of 2048 tokens."""
    return packing.packed(docs, TOKENIZER, size=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("private", private),
    ("packed", packed),
]

#: Tokenizing and the search for few sequences have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
