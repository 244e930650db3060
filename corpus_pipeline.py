"""The corpus pipeline: five stages over documents, each working on what the one before it kept and wrote.

All stages take nulls in any column, empty and very long texts, repeated rows, empty tables and further columns of any name.
Null ids never match each other; what repeated rows and ties give is said at each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import byte_bpe
from tidemark.llm.common import fresh, staged
from tidemark.llm.language_id import UND, MixtureModel, language_id
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.ngram_jaccard import bounded, ngram_jaccard
from tidemark.llm.source_mixing import mix_sources

#: A document goes if its languages explain its trigrams no better than this, in nats a trigram above no language at all.
LEAST_FIT = 0.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those that no mixture of learned languages explains; with no language to learn, none.

    A null or empty text has no letter and goes. Equal rows go or stay together.
    """
    model = MixtureModel.fit(docs)
    if not model.langs:
        return docs
    lang, share, fit = fresh(docs, "predicted"), fresh(docs, "share"), fresh(docs, "fit")
    found = language_id(docs, model, out=lang, score=share, fit=fit)
    return found.filter((F.col(lang) != UND) & (F.col(fit) > LEAST_FIT)).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out that match an earlier line; n_chars follows the text.

    Every document stays, at the worst with an empty text; a null text stays null. Rows with one id and text lose the same lines.
    """
    done = line_dedup(docs).select(docs.columns)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done


def dedup_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group, the one with the smallest id; rows without an id or words stay.

    Rows that repeat an id go or stay together.
    """
    gone = bounded(staged(ngram_jaccard(docs).filter("component_id <> doc_id").select("doc_id"), "gone"))
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source of its own; rows without words are taken 0 times. Which of several equal rows is taken twice can't
    be told apart.
    """
    row = fresh(docs, "row")
    whole = docs.withColumn(row, F.struct(*docs.columns))
    mixed = mix_sources(whole, keep=(row,)).filter("copies > 0")
    return mixed.select(row, F.explode(F.sequence(F.lit(1), "copies"))).select(f"{row}.*")


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with digests of the ids and of the bytes that they decode to. Each row gives a row; a null
    text has no ids."""
    return byte_bpe(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", dedup_ngrams),
    ("source_mixing", mix_to_targets),
    ("byte_bpe", encode_bytes),
]

#: Mixtures of languages and token ids have no SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each but the last written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
