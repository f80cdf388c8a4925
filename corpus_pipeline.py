"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on everything its
predecessor kept and returns a DataFrame. All but the last return the columns
of ``documents``; the last returns the packed pieces of what is left.

Defined cases of all stages: NULL ids are kept like any other; other columns,
whatever their names, pass through the filtering stages untouched and are
ignored by the last; texts of any length are read whole; an empty table gives
an empty result. What each stage does with NULL and empty texts, ties and
repeated rows stands below.

Stages and the operators in them write intermediate tables to the shared
checkpoint folder; ``tidemark.session.release`` removes them once the result
has been stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.exact_dedup import drop_copies
from tidemark.llm.language import drop_rejected
from tidemark.llm.packing import pack_documents
from tidemark.llm.simhash import drop_near_copies
from tidemark.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the language model rejects. NULL, empty and
    letterless texts go; rows of equal id and text share their answer, equal
    similarities go to the first centroid."""
    return drop_rejected(docs)


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts: the one with the most
    code points, then the smallest id (NULL ids last), one row of repeated
    ones. NULL texts equal empty ones."""
    return drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group: the smallest id, one row of
    repeated ones. NULL and wordless texts form one group."""
    return drop_near_copies(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark. NULL and wordless
    texts hold none; repeated rows share their answer."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences. A NULL or empty text is its
    end id alone; repeated rows are packed each; equal lengths go by id."""
    return pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", remove_exact_copies),
    ("simhash_near_dedup", remove_near_copies),
    ("benchmark_decontamination", remove_benchmark),
    ("best_fit_packing", pack_sequences),
]

#: a trained classifier and a tokenizer have no SQL: see tests/llm/test_llm_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name=f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
