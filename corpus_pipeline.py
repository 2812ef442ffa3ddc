"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run`
writes as Parquet and rereads as the next stage's input. All but the last return
the columns of their input. Null texts count as empty; an empty table passes
through as one; other columns are carried along whatever their names. Repeated
rows are kept or dropped alike until near duplicates go. Texts are taken whole,
however long.

When a stage begins, the temporary tables of the one before it are removed, as
its output has been written by then: one pipeline at a time in a session.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scope, written
from millrace.llm.ngram_join import NgramJaccardJoin
from millrace.llm.packing import PackedCorpus
from millrace.llm.quality_cascade import QualityCascade
from millrace.llm.secret_scan import SecretScan
from millrace.llm.toxicity import ToxicityModel, fold_of

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TEMPORARY = Scope()
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def stage(work: Stage) -> Stage:
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        TEMPORARY.drop(spark)
        with TEMPORARY:
            return work(spark, docs, sf_dir)

    return run


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return QualityCascade(docs).kept(docs)


@stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = ToxicityModel(docs, labels, fold_of(F.col("doc_id")) != 0)
    return docs.where(model.score(F.col("text")) < 0.5)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by word shingles."""
    found = NgramJaccardJoin(docs, size=5, percent=80).documents()
    return docs.join(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


@stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every found secret replaced by a mark; n_chars follows the text."""
    clean = docs.withColumn("text", SecretScan().redacted(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return PackedCorpus(docs, TOKENIZER).placed()


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

# Tokenizing and scoring can't be said in SQL; the pipeline is tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = written(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
