"""Operators as filtering stages over the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergewell.llm.common import free_name
from mergewell.llm.quality import score_texts
from mergewell.llm.toxicity import train_toxicity

TOXIC_FROM = 0.5


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """documents whose whole text scores below TOXIC_FROM; all columns, whatever their names, stay.

    Null and empty texts are scored as empty; repeated rows are scored alike. Without labels of both
    classes every document has the share of toxic labels as its score. An empty table stays empty.
    """
    score = free_name(documents, "score")
    return score_texts(documents, train_toxicity(documents, labels), into=score).where(F.col(score) < TOXIC_FROM).select(*documents.columns)
