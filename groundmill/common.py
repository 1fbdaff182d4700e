"""Helpers shared by every operator: tables, ids, durable cut points, checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows and bytes up to which a side may be broadcast; beyond either Spark plans the join by size.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def norm_id(col: Column | str) -> Column:
    """Ids compare without letter case, surrounding blanks and braces."""
    col = F.col(col) if isinstance(col, str) else col
    return F.lower(F.regexp_replace(col, r"(?U)^[\s{}]+|[\s{}]+$", ""))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in spark.checkpoint.dir; only without one make our own."""
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    master = spark.sparkContext.master
    if not named and not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
    spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="groundmill-"))


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage at a reliable checkpoint, which outlives any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only for a side of at most ``most`` rows and ``most_bytes`` bytes; else the planner decides. The side is
    measured by running it, so it should be a scan or durable."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    rows, held = df.limit(most + 1).agg(F.count("*"), F.coalesce(size, F.lit(0))).head()
    return F.broadcast(df) if rows <= most and held <= most_bytes else df


def running(df: DataFrame, group: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``df`` with running sums within each group in a total order, the row itself included; ``sums`` of lit(1) number the
    rows. Rows are cut into ranges of (group, order); what lies before a range in its group is added to the sums within it,
    so no task holds a group as a whole. ``order`` must be unique within a group."""
    cut = durable(df.withColumns(sums).repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()))
    names = list(sums)
    totals = cut.groupBy("_range", *group).agg(*[F.sum(n).alias(f"_all_{n}") for n in names])
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = totals.select(F.col("_range").alias("_r"), *[F.col(g).alias(f"_g_{g}") for g in group], *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_at_{n}") for n in names])
    within = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({n: F.sum(n).over(within) for n in names})
    same = (F.col("_range") == F.col("_r"))
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    joined = local.join(starts, same)
    return joined.withColumns({n: (F.col(n) + F.col(f"_at_{n}")).cast("bigint") for n in names}).select(*df.columns, *names)


def squeeze(col: Column | str) -> Column:
    """Runs of any Unicode blank become one space; ends are trimmed."""
    col = F.col(col) if isinstance(col, str) else col
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))
