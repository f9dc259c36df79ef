"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (alignment, bpe, byte_repeats, line_rules, mixture, passages, pseudonyms, quality_votes, simhash, two_fit, variants,
                          voronoi_knn, warc)
from tidemark.llm.common import reachable, table
from tidemark.llm.oracle import SQL
from tidemark.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(SQL)

#: The tokenizer files of the registered queries; every worker has the package.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
#: The key of the pseudonyms in the registered query; a real run takes its own from a secret store.
KEY = "registered-query"


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(reachable(tune(spark)), folder)

    QUERIES[function.__name__] = run
    return function


@query
def op1_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality_votes.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_byte_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document under strings of 50 bytes that an earlier document has too, removed."""
    return byte_repeats.remove_repeats(table(spark, folder, "documents"), with_text=False)


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of near duplicates of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of the ids and the decoded text of every document."""
    return bpe.digests(table(spark, folder, "documents"), TOKENIZER)


@query
def op5_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    return mixture.mix(table(spark, folder, "documents"))


@query
def op6_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the personal data of their texts replaced."""
    return pseudonyms.replace_personal_data(table(spark, folder, "documents"), KEY)


@query
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    return warc.round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and the verdict of line-first cleaning for every document."""
    return line_rules.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op9_voronoi_knn(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best other vectors of every vector whose id is divisible by 20."""
    return voronoi_knn.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op10_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that stand in a repeated window of 35 words, removed."""
    return passages.remove_repeated(table(spark, folder, "documents"), with_text=False)


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every frequent word with its near words, its more frequent form, and the root that its forms lead to."""
    return variants.spelling_forms(table(spark, folder, "documents"))


@query
def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The tokens of every document, in pieces packed into sequences of 2,048."""
    return two_fit.pack(table(spark, folder, "documents"), BYTE_TOKENIZER)


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    return alignment.align(table(spark, folder, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)
