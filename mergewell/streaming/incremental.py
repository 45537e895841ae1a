"""Incremental runs: Structured Streaming over landed files, and control tables for cursors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def process_new_files(spark: SparkSession, source: str, schema, checkpoint: str, handle: Callable[[DataFrame, int], None], max_files: int | None = None) -> None:
    """Hands all files that arrived since the last run to handle(batch, batch_id), then returns.

    The checkpoint is the durable cursor: it moves only once a batch is done, so a failed batch is repeated
    and handle must be idempotent. Late rows are never dropped: no watermark is set.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = reader.parquet(source).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def unique_stream(spark: SparkSession, source: str, schema, key: str, target: str, checkpoint: str) -> None:
    """Appends to target the first row of each key ever seen; the seen keys are the stream's state."""
    rows = spark.readStream.schema(schema).parquet(source)
    rows.dropDuplicates([key]).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def advance_watermarks(watermarks: DataFrame, fetched: DataFrame, minutes: int = 5) -> DataFrame:
    """(source_id, watermark_at): the newest fetch less the safety margin, for sources without errors that sent rows; others keep theirs.

    fetched has source_id, fetched_at, sent and errors for each run.
    """
    runs = fetched.groupBy("source_id").agg(F.max("fetched_at").alias("newest"), F.sum("sent").alias("sent"), F.sum("errors").alias("errors"))
    ready = (F.col("errors") == 0) & (F.col("sent") > 0) & F.col("newest").isNotNull()
    both = watermarks.join(runs, "source_id", "full_outer")
    moved = F.when(ready, F.greatest(F.col("newest") - F.make_dt_interval(mins=F.lit(minutes)), F.col("watermark_at")))
    return both.select("source_id", F.coalesce(moved, "watermark_at", F.lit(EPOCH).cast("timestamp")).alias("watermark_at"))


def pages_until(pages: DataFrame, watermark: Column, page: str = "page", stamp: str = "cursor_at", source: str = "source_id") -> DataFrame:
    """Pages up to and with the first whose oldest record is not newer than the watermark, for each source."""
    oldest = pages.groupBy(source, page).agg(F.min(stamp).alias("oldest"), F.first(watermark).alias("mark"))
    stop = oldest.where(F.col("oldest") <= F.col("mark")).groupBy(source).agg(F.min(page).alias("stop"))
    return pages.join(stop, source, "left").where(F.col("stop").isNull() | (F.col(page) <= F.col("stop"))).drop("stop")


def cursor_after(rows: DataFrame) -> DataFrame:
    """(entity_type, cursor_created_at, cursor_id): the furthest row of each type, for a control table."""
    furthest = rows.groupBy("entity_type").agg(F.max(F.struct("created_at", "id")).alias("c"))
    return furthest.select("entity_type", F.col("c.created_at").alias("cursor_created_at"), F.col("c.id").alias("cursor_id"))


def delta_after(rows: DataFrame, cursors: DataFrame) -> DataFrame:
    """Rows beyond their type's cursor; types without one give all."""
    joined = rows.join(cursors, "entity_type", "left")
    beyond = F.col("cursor_id").isNull() | (F.struct("created_at", "id") > F.struct(F.col("cursor_created_at").alias("created_at"), F.col("cursor_id").alias("id")))
    return joined.where(beyond).select(*rows.columns)
