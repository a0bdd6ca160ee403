"""From raw documents to a training mix: the stages of a corpus pipeline.

Each stage reads the Parquet table that the one before wrote. ORACLE_SQL is
None: profiles, fingerprint search and spaced seeds are not expressible in SQL;
``tests/llm/test_pipeline.py`` holds the result against a brute-force version.

Every stage takes any table with doc_id, text, lang and source: other columns
pass through whatever their names, an empty table gives an empty one, texts are
read whole whatever their length, and rows that repeat an id are judged by
their own texts. What null and empty texts, null ids and ties give is said at
each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txpulse.llm import decontaminate, exact_dedup, jaccard_join, language_id, mixing
from txpulse.llm.common import fresh, table, word_count, written

#: A text whose nearest profile is further off than this is in no learned language.
LEAST_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, so null and empty ones too, or in no learned language."""
    label, score = fresh(docs, "lang_pred"), fresh(docs, "score")
    judged = language_id.identify(docs)
    known = (F.col(label) != language_id.UNKNOWN) & (F.col(score) >= LEAST_SCORE)
    return judged.where(known).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays; rows that repeat id and text become one.

    A null id stays only where its text has no other; null and empty texts are equal.
    """
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by links of Jaccard 0.8 on five-word shingles the smallest doc_id stays.

    Null ids, and texts without words, stay.
    """
    return jaccard_join.keep_one(docs, k=5, num=4, den=5)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark passage; null and empty texts contain none."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in its order, with the words that it takes of each.

    Documents of no words go. Rows that repeat id, source and size are taken alike.
    """
    return mixing.mixed_documents(docs, word_count(F.col("text")))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("mix", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
