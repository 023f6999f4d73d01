"""The corpus pipeline: language ID, toxicity, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), decides on whole documents and returns those it keeps with
the columns of documents; the last returns the packed pieces. Between stages the documents are
written as Parquet in the shared folder and read again, so a lost executor costs tasks of one stage.
Decisions are made row by row: rows with equal or null ids, or equal in all columns, are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm import decontamination, files, language_id, near_dup, packing, toxicity
from folioframe.llm.shared import numbered, saved, work_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document stays if its most likely language has at least this probability.
LEAST_LANGUAGE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language is in doubt."""
    docs = docs.select(*COLUMNS)
    models = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"), 5)))
    scored = language_id.predict(docs, models, lang="__lang", score="__score")
    return scored.where((F.col("__lang") != language_id.UNKNOWN) & (F.col("__score") >= LEAST_LANGUAGE)).select(*COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the severity model calls toxic."""
    docs = docs.select(*COLUMNS)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = toxicity.scorer(docs, model)
    return docs.select(*COLUMNS, score("text").alias("s")).where(~F.col("s.toxic")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones stays: that with the least id, and of equal ids the first one stored."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__file", "__row")
    docs = numbered(docs.select(*COLUMNS), "__file", "__row").withColumn("__key", row)
    groups = near_dup.similar_components(docs, "__key")
    dropped = files.row_set(groups.where(F.col("__key") != F.col("component_id")).select("__key.__file", "__key.__row"), "__file", "__row")
    return docs.where(~dropped(F.col("__file"), F.col("__row"))).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.without_items(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: SQL has neither the classifiers nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = work_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"{path}/{k}-{name}")
    return docs
