"""The corpus pipeline: documents in, encoded training rows out.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
documents.  All but the last return the columns of documents, and every stage
works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.llm import language_kn, sentencepiece_unigram
from clipstat.llm.common import column, materialise
from clipstat.llm.line_templates import dedup_lines
from clipstat.llm.simhash_bk import one_of_each, simhash_groups
from clipstat.llm.source_mix import mix, mixed_documents

#: SQL for run()'s rows: language models and BK-trees have none.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no learned language accepts go, those without a letter among them; a null lang is filled in.

    Without any labelled document there is no model to reject with, and all stay.
    """
    model = language_kn.fit(docs)
    if not model.languages:
        return docs
    got = language_kn.identify(docs, model).where(~F.col("lang_rejected"))
    return got.select(*[F.coalesce("lang", "lang_pred").alias("lang") if c == "lang" else column(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from all documents but the first; a document may be left with an empty text."""
    got = dedup_lines(docs)
    return got.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else column(c) for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-copies the document with the smallest id stays.

    Texts without words (null, empty) are one group; of rows that repeat id and
    text one stays; rows without an id stay.
    """
    return one_of_each(docs, simhash_groups(docs, shingle=4, max_bits=4, text_key=True))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document; the one at the end of a source's quota may be cut short."""
    return mixed_documents(docs, mix(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, round_trip): the piece ids, and whether they decode to the text."""
    coded = sentencepiece_unigram.encode(docs.select("doc_id", "lang", "source", "text"),
                                         sentencepiece_unigram.load_pieces(), check_col="round_trip")
    return coded.select("doc_id", "lang", "source", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a table in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
