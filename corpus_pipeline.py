"""The corpus pipeline: five stages from raw documents to a training mix.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir)
and returns what goes on. All but the last return the columns of ``documents``;
the last adds ``copy_no``. ``run`` writes each stage's rows to the shared folder
and reads them again, so a lost executor costs tasks, not the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.llm import let_workers_import
from paymart.llm.decontamination import judge_documents
from paymart.llm.near_dedup import keep_one_per_group
from paymart.llm.quality_classifier import classify_quality
from paymart.llm.source_mixing import mix_sources
from paymart.llm.substring_dedup import dedup_substrings
from paymart.session import work_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    let_workers_import(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify_quality(docs, labels).where("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    let_workers_import(spark)
    return keep_one_per_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages. Texts without any stay as they
    are; of the others the kept words, joined by one space, and their length."""
    let_workers_import(spark)
    cut = dedup_substrings(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    length = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumns({"text": text, "n_chars": length}).select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    let_workers_import(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return judge_documents(docs, benchmark).where("NOT contaminated").select(docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents in the target mix of sources, shuffled."""
    let_workers_import(spark)
    return mix_sources(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
]

#: The classifier is trained, so SQL can't express the stages; they are tested
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
