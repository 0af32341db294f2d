"""From raw documents to packed training sequences, in five stages.

Each stage takes all rows its predecessor kept and returns a DataFrame, which is written
as Parquet and read again before the next; all but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweft.llm import quality_nbsvm
from linkweft.llm.decontaminate import drop_leaks
from linkweft.llm.frames import ship, table, written
from linkweft.llm.near_dedup import keep_one
from linkweft.llm.packing import pack_documents
from linkweft.llm.substring import remove_repeats

# Least probability of good quality that a document needs to stay.
LEAST_QUALITY = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents which the classifier does not reject."""
    ship(spark)
    model = quality_nbsvm.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_nbsvm.score(docs, model, out="_quality")
    return scored.where(F.col("_quality") >= LEAST_QUALITY).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id."""
    ship(spark)
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; others keep their text as it is."""
    ship(spark)
    cut = remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return cut.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    ship(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    import public_tokenizers

    ship(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# SQL cannot express the classifier and the tokenizer; tests hold every stage and the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
