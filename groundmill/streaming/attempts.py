"""Structured Streaming additions: heartbeat of attempts, new proposals once, entities as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.operators.entities import resolve_or_create


def heartbeat(attempts: DataFrame, every: str = "1 minute", late: str = "10 minutes", time: str = "at") -> DataFrame:
    """Tumbling counts of attempts; works on a stream and on a table."""
    a = attempts.withWatermark(time, late) if attempts.isStreaming else attempts
    return a.groupBy(F.window(time, every)).agg(F.count("*").alias("attempts"), F.count_if("ok").alias("accepted")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "attempts", "accepted")


def once(proposals: DataFrame, key: str, late: str = "1 day", time: str = "at") -> DataFrame:
    """Each proposal the first time it comes within the watermark."""
    return proposals.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def entity_log(path: str):
    """A foreachBatch function that appends the distinct surfaces of a batch under ``path``; a batch that is run again overwrites
    its own folder only. What was written before is never rewritten: ``entities_of`` folds it when it is read."""

    def run(batch: DataFrame, n: int) -> None:
        first = batch.groupBy("entity_type", "surface").agg(F.min(F.struct("ordinal", "record_id")).alias("f"))
        first.select("entity_type", "surface", "f.record_id", "f.ordinal").write.mode("overwrite").parquet(f"{path}/batch={n}")

    return run


def entities_of(spark: SparkSession, path: str, existing: DataFrame | None = None) -> DataFrame:
    """Entities of every batch of ``entity_log`` so far."""
    return resolve_or_create(spark.read.parquet(path).drop("batch"), existing)
