"""From ``documents`` to packed training sequences: language, repeated lines, near copies, source mix, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of docs and returns a frame; all but the last keep the columns
of documents. ``run`` writes each stage's rows as Parquet into the shared folder and reads them for the next one.
Null texts, empty texts, repeated rows and empty tables follow the operators' own definitions; extra columns keep their
values, also those with names that the operators use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweft.llm.common import aside, table, written
from claimweft.llm.language import UNDETERMINED, fit, identify
from claimweft.llm.line_dedup import dedup_lines
from claimweft.llm.mixing import taken
from claimweft.llm.near_dedup import one_of_each
from claimweft.llm.packing import default_tokenizer, pack_documents

#: A document whose words lean to no language even so much is rejected, like one without letters.
LEAST_LANGUAGE_SCORE = 0.3


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of undetermined language. The model learns from the labelled rows of the documents themselves.

    Where no row has a label, nothing can be told apart, and every document with letters stays.
    """
    held, back = aside(docs, ("lang_pred", "score"))
    model = fit(held)
    if not model.langs:
        return docs.where(F.col("text").rlike("\\p{L}"))
    return back(identify(held, model).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated chunks of lines and bring n_chars up to date; a document of which nothing is left goes."""
    held, back = aside(docs, ("n_lines", "n_removed", "n_chunks"))
    kept = back(dedup_lines(held).where(F.col("text").isNull() | ~((F.col("n_chunks") > 0) & ~F.col("text").rlike("\\S"))))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else kept


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id; texts without words all stay."""
    return one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return taken(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return pack_documents(docs, default_tokenizer())


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", remove_repeated_lines),
    ("minhash_near_dedup", keep_one_of_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Language models, hashing and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
