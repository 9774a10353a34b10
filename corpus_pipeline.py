"""A corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Language ID drops texts without a letter and those in which no language is likelier than all others together; near dedup keeps one document of each group of texts that share
four fifths of their five-word shingles; substring dedup cuts out passages that an earlier document
holds; the mixture repeats and drops documents so that sources come in the shares wanted; the
last stage gives the ids of the SentencePiece model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import language, mixture, pieces, repeats, setsketch
from starloom.llm.components import broadcast_if_few, stored
from starloom.session import scratch_path

LEAST_LANGUAGE_SCORE = 0.5  # what the likeliest language must reach, of 1 for all

ORACLE_SQL = None  # trained models and hashed sketches; tests/llm holds the stages against brute force


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops null texts, texts without a letter, and texts whose likeliest language scores below the least score."""
    return language.determined(docs, language.fit(docs), least=LEAST_LANGUAGE_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies; of rows alike in id and text, one."""
    found = setsketch.near_duplicates(docs, width=5, percent=80)
    dropped = found.where("not kept").select(F.col("doc_id").alias("_id"))
    repeated = docs.groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("n")).where("n > 1").select("_id")
    out = broadcast_if_few(stored(dropped.distinct(), "dropped"))
    kept = docs.join(out, docs["doc_id"] == out["_id"], "left_anti")
    again = stored(repeated.where("_id is not null").join(out, "_id", "left_anti"), "repeated")
    if again.isEmpty():
        return kept
    again = broadcast_if_few(again)
    once = kept.join(again, kept["doc_id"] == again["_id"], "left_anti")
    return once.union(kept.join(again, kept["doc_id"] == again["_id"], "left_semi").dropDuplicates(["doc_id", "text"]))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts 13-word passages out of all documents but the first that holds them; other texts stay as they are."""
    counts = ("_n_words", "_n_removed")
    cut = repeats.remove_repeats(docs, size_col="n_chars", columns=docs.columns, normal=False, counts=counts)
    return cut.drop(*counts)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents until every source has its target."""
    return mixture.mixed_documents(docs, size_col="n_chars")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text of the mix; ``exact`` tells that decoding gives the text."""
    return pieces.encode(docs)


STAGES = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("source_mixture", mix_sources),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
