"""One query per operator, over the whole of its table, and the SQL some must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.best_fit import pack_documents
from tidemark.llm.fertility import measure_quality
from tidemark.llm.hard_negatives import mine_negatives
from tidemark.llm.licence_scan import scan_licences
from tidemark.llm.log_bilinear import score_documents
from tidemark.llm.ngram_join import similar_classes
from tidemark.llm.oracle import ORACLE_SQL  # noqa: F401
from tidemark.llm.page_text import extract_text
from tidemark.llm.phrases import collocations
from tidemark.llm.robust_graph import link_embeddings
from tidemark.llm.secret_scan import scan_secrets, secret_digest
from tidemark.llm.sharding import shard_documents
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.unigram import encoding_digest
from tidemark.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Vocabularies, by file name in the folder of public tokenizers.
PIECES = "piece_bpe_32k.model"
WORD_PIECES = "word_bpe_49k.json"
MANY_LANGUAGES = "byte_bpe_multi_50k.tiktoken"


def vocabulary(name: str) -> str:
    """The path of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(pin_utc(spark), sf_dir)
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op2_secret_scan(spark, sf_dir):
    return secret_digest(scan_secrets(documents(spark, sf_dir)))


@query
def op5_jump_sharding(spark, sf_dir):
    return shard_documents(documents(spark, sf_dir), shards=16)


@query
def op7_fertility_quality(spark, sf_dir):
    return measure_quality(
        documents(spark, sf_dir), vocabulary(PIECES), vocabulary(MANY_LANGUAGES)
    )


@query
def op4_token_counts(spark, sf_dir):
    return count_tokens(documents(spark, sf_dir), vocabulary(WORD_PIECES), limit=2048)


@query
def op8_best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), vocabulary(WORD_PIECES), capacity=4096)


@query
def op9_unigram_encoding(spark, sf_dir):
    return encoding_digest(documents(spark, sf_dir), vocabulary(PIECES))


@query
def op10_log_bilinear_scores(spark, sf_dir):
    return score_documents(documents(spark, sf_dir))


@query
def op3_ngram_join(spark, sf_dir):
    return similar_classes(documents(spark, sf_dir))


@query
def op1_robust_graph_links(spark, sf_dir):
    return link_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op6_licence_scan(spark, sf_dir):
    return scan_licences(documents(spark, sf_dir))


@query
def op13_top_order_phrases(spark, sf_dir):
    return collocations(documents(spark, sf_dir))


@query
def op12_bit_plane_negatives(spark, sf_dir):
    return mine_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op11_minimum_cut_pages(spark, sf_dir):
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
