"""A training corpus from raw documents, in stages that each write Parquet for the next.

Documents whose language can't be told go; then exact copies; then all but one
of each group of near-duplicates; the sources are mixed to their weights; and
the mix is encoded into tokens and decoded again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm import exact_dedup, language, mixing, near_dup
from loomset.llm.bpe import Tokenizer
from loomset.llm.common import fresh, table, written


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model doesn't reject, learned from those outside the held-out fold.

    Null texts and texts without a letter go, and texts far from every language.
    """
    return language.accepted(docs, language.fit(docs, ~language.held_out()))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dup.drop_near_copies(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weighted queue of their source takes them."""
    return mixing.mix(docs)


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as tokens: ``text`` is what its ``ids`` decode to, ``n_tokens`` their number; other columns unchanged."""
    ids, decoded = fresh(docs, "ids"), fresh(docs, "decoded")
    tokenizer = Tokenizer(
        spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    back = tokenizer.there_and_back(docs, ids=ids, decoded=decoded)
    text = F.col(decoded).cast("string").alias("text")
    return back.select(
        *[text if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.col(ids),
        F.size(ids).alias(fresh(docs, "n_tokens")),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_and_decode),
]

#: Language rejection, MinHash and subwords are beyond SQL; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
