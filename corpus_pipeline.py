"""From raw documents to packed training sequences, in four stored stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.
All but the last return the columns of documents; the last returns a row per piece. Empty
tables give empty ones; further columns stay as they are, under any names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.best_fit import pack_documents
from tidemark.llm.components import drop_table
from tidemark.llm.fertility import FertilityRules, keep_good
from tidemark.llm.ngram_join import JoinRules, drop_similar
from tidemark.llm.queries import MANY_LANGUAGES, PIECES, WORD_PIECES, documents, vocabulary
from tidemark.llm.secret_scan import redact_secrets
from tidemark.session import pin_utc
from tidemark.sources.scratch import delete_path, materialize, recorded_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Later stages need the workers' memory too, so fewer words are remembered.
QUALITY = FertilityRules(most_kept=60_000)
# Near copies: five words, four fifths in common.
NEAR_COPIES = JoinRules(width=5, percent=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the tokeniser's fertility reject go. Null and empty
    texts are among them; a null language is held against its script."""
    return keep_good(docs, vocabulary(PIECES), vocabulary(MANY_LANGUAGES), QUALITY)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, whatever its ids: null and repeated
    ids are judged by their texts. Texts without words all stay."""
    return drop_similar(docs, NEAR_COPIES)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays, null texts as they are."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 4096, of every row: a null or empty
    text is one piece of length 1."""
    return pack_documents(docs, vocabulary(WORD_PIECES), capacity=4096, most_kept=60_000)


# Scratch paths of the stage that ran last, by application.
_left: dict[str, list[str]] = {}


def _freeing(function: Stage) -> Stage:
    """The stage, which first deletes what its predecessor still needed: that one's result
    is stored by now. What `docs` reads from stays, should it not be stored after all."""

    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        left = _left.pop(app, [])
        files = docs.inputFiles() if left else []
        for path in left:
            if not any(path in file for file in files):
                delete_path(spark, path)
        with recorded_scratch() as made:
            result = function(spark, docs, sf_dir)
        if function is not packing:
            _left[app] = made
        return result

    return stage


STAGES = [
    ("quality", _freeing(quality)),
    ("near_copies", _freeing(near_copies)),
    ("secrets", _freeing(secrets)),
    ("packing", _freeing(packing)),
]

# SQL expresses neither the vocabularies nor the filters of the join.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one returns is stored and read by the next."""
    docs, before = documents(pin_utc(spark), sf_dir), None
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_table(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
