"""Corpus preparation: toxicity, line dedup, near-dedup, decontamination and SentencePiece, each stage over what its predecessor kept."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from mergewell.llm.decontaminate import drop_contaminated
from mergewell.llm.line_templates import drop_recurring_lines
from mergewell.llm.near_dup import keep_first
from mergewell.llm.queries import tokenizer_path
from mergewell.llm.stages import drop_toxic
from mergewell.llm.tokens import tokenise
from mergewell.session import shared_folder, spread

#: No SQL expresses compression distances or SentencePiece; a test replays the stages in plain Python.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go; null and empty texts are scored as empty. All columns stay."""
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go, every document stays; null and empty texts as they are."""
    return drop_recurring_lines(docs)[0]


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies by five-word shingles, as all near-duplicate stages; null and empty texts are one class."""
    return keep_first(docs, width=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts stay."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and digests of each whole text; a null text is empty."""
    return tokenise(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("sentencepiece", sentencepiece)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to documents; the results between them are Parquet files in the shared folder, each deleted once its successor is written."""
    docs = spread(_table(spark, sf_dir, "documents"))
    folder = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
        if 0 < i < len(STAGES) - 1:
            _delete(spark, f"{folder}/{i - 1}-{STAGES[i - 1][0]}")
    return docs


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
