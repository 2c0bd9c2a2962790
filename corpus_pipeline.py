"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes all that the one before kept, is written as Parquet, and is reread.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbridge.llm import exact_dedup, language_id, near_dedup, packing, quality_rules
from tarnbridge.llm.common import every_column, held_out, stored, table
from tarnbridge.llm.queries import BYTE_BPE

#: A document stays if its language's probability is at least this. Of 1,865 held-out texts of 50 words or more on sf0.1
#: none has less than 0.6; texts in Polish, Finnish, Turkish, Russian, Japanese and of random letters have 0.12 at most.
MIN_LANGUAGE_SCORE = 0.3

#: Bytes of rows that Spark sends to a Python worker at a time, unless the session sets its own bound: Spark's default of
#: 64 MB is held by the JVM, often twice, and by the worker, for every running task.
BATCH_BYTES = 4 << 20
_BATCH_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Different words in each of the two generations that a worker keeps with their ids.
KEEP_WORDS = 100_000


def _free(name: str, docs: DataFrame) -> str:
    """The name, or one made from it that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _small_batches(spark: SparkSession) -> None:
    """Bounds what goes to Python at a time; a later plan of the session takes the bound, and no result depends on it."""
    if _BATCH_BOUND not in spark.conf.getAll:
        spark.conf.set(_BATCH_BOUND, BATCH_BYTES)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, with all their columns.

    A null, empty or short text fails the rules. Repeated rows are judged alike. Rules are applied to
    whole texts of any length. Columns named like the rules' results come through as they are. No rows give none.
    """
    row = _free("row", docs)
    held = docs.select(F.struct(*every_column(docs)).alias(row), docs["text"].alias("text"))
    return quality_rules.quality_rules(held).filter("kept").select(f"{row}.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a language that the network, fitted to these documents, knows and finds likely.

    A null or empty text, and one without a letter, goes; where no document has a language, all go.
    Repeated rows are judged alike, and texts of any length by all their letters. All columns come
    through. No rows give none.
    """
    _small_batches(spark)
    model, langs = language_id.fit_languages(docs, ~held_out())
    found = _free("predicted", docs)
    known = (F.col(f"{found}.lang_pred") != language_id.UNKNOWN) & (F.col(f"{found}.score") >= MIN_LANGUAGE_SCORE)
    return language_id.languages(docs, model, langs, column=found).filter(known).drop(found)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, with all columns: see ``exact_dedup.drop_exact`` for nulls, ties and repeated rows."""
    return exact_dedup.drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, with all columns: see ``near_dedup.drop_near`` for nulls, ties and repeated rows."""
    _small_batches(spark)
    return near_dedup.drop_near(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in pieces of power-of-two lengths, a row for each: see ``packing.pack``. A null text is one piece of one token."""
    _small_batches(spark)
    return packing.pack(docs, BYTE_BPE, keep_words=KEEP_WORDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [("quality rules", quality), ("language id", language), ("exact dedup", exact), ("near dedup", near), ("packing", pack)]

#: Two stages are models or samples, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the documents in ``sf_dir`` that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
