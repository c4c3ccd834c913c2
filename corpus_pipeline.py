"""Corpus pipeline: from raw documents to packed training sequences, one operator a stage.

A null in any column, an empty text or an empty table goes through every stage; the stages'
own modules state what each does with it. Rows are told apart by doc_id or, where ids are null or
repeat, by doc_id and text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm import common, exact_dedup, language, mixing, ngram_join, packing, tokens


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; the others go."""
    name = common.free_name(docs, "found")
    found = language.identified(docs, language.fit(docs), name)
    return found.filter(~F.col(name)["rejected"]).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group: that with the smallest doc_id."""
    number = common.free_name(docs, "_number")
    rows, _ = common.numbered(docs, number)
    classes = ngram_join.ngram_join(rows, id_col=number)
    gone = classes.filter("doc_id <> component_id").select(F.col("doc_id").alias(number)).distinct()
    return rows.join(gone, number, "left_anti").select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: whole passes, and one more where the mix takes at
    least half of its words again. Documents that the mix doesn't reach go."""
    number, key, copies, copy = (common.free_name(docs, c) for c in ("_number", "_id", "_copies", "_copy"))
    rows, _ = common.numbered(docs, number)
    taken = mixing.mix(rows, id_col=number).filter("size > 0")
    times = taken.groupBy(F.col("doc_id").alias(key)).agg(F.max(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int").alias(copies))
    out = rows.join(times.filter(F.col(copies) > 0), F.col(number) == F.col(key))
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokens.public_path("word_bpe_49k.json"), 4096, 1)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("ngram_join", near_duplicates),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: Tokenizing and training can't be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
