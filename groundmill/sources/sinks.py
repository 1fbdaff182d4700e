"""Writing: append-only tables, throwaway namespaces, exports, isolation of what must not change."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.common import norm_id
from groundmill.functions.text import uuid_key

# What a label and an identifier may be.
LABEL = re.compile(r"^[a-z0-9_]{1,40}$")
IDENTIFIER = re.compile(r"^[a-z_][a-z0-9_]*$")


class WriteOnceError(ValueError):
    """A row with an id that is already there."""


def qualified(schema: str, table: str) -> str:
    """schema.table, both checked before any statement is made of them."""
    for name in (schema, table):
        if not IDENTIFIER.fullmatch(name):
            raise ValueError(f"not an identifier: {name!r}")
    return f"{schema}.{table}"


def create_namespace(spark: SparkSession, label: str) -> str:
    if not LABEL.fullmatch(label):
        raise ValueError(f"not a label: {label!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS probe_{label}")
    return f"probe_{label}"


def drop_namespace(spark: SparkSession, label: str) -> None:
    if not LABEL.fullmatch(label):
        raise ValueError(f"not a label: {label!r}")
    spark.sql(f"DROP DATABASE IF EXISTS probe_{label} CASCADE")


def append_once(rows: DataFrame, path: str, key: str) -> None:
    """Appends rows whose ids are new and all different; there is no path to update. One writer at a time."""
    spark = rows.sparkSession
    twice = rows.groupBy(norm_id(key).alias("k")).count().filter("count > 1").limit(1).collect()
    if twice:
        raise WriteOnceError(f"{key} {twice[0]['k']} twice in the batch")
    try:
        old = spark.read.parquet(path).select(norm_id(key).alias("k"))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = None
    if old is not None:
        known = rows.select(norm_id(key).alias("k")).join(old, "k", "left_semi").limit(1).collect()
        if known:
            raise WriteOnceError(f"{key} {known[0]['k']} is already written")
    rows.write.mode("append").parquet(path)


def current(records: DataFrame) -> DataFrame:
    """Records that no other supersedes."""
    gone = records.filter("supersedes IS NOT NULL").select(norm_id("supersedes").alias("_s")).distinct()
    return records.join(gone, norm_id("record_id") == F.col("_s"), "left_anti")


def export_rows(records: DataFrame, frags: DataFrame) -> DataFrame:
    """Records with their verdict and the result of cutting the span anew, in order of place."""
    f = frags.select(F.col("chunk_id").alias("_f"), F.coalesce("text", F.lit("")).alias("_t"))
    j = records.join(f, norm_id("source_chunk_id") == F.col("_f"), "left")
    same = F.substring(F.coalesce("_t", F.lit("")), F.col("char_start") + 1, F.col("char_end") - F.col("char_start")) == F.col("evidence_span")
    return j.withColumns({"verdict": F.col("provenance_validation.verdict"), "slice_check": F.when(same, "OK").otherwise("MISMATCH!")}).drop("_f", "_t").orderBy("source_chunk_id", "char_start", "record_id")


def export_jsonl(records: DataFrame, frags: DataFrame, path: str) -> None:
    export_rows(records, frags).write.mode("errorifexists").json(path)


def export_audit(records: DataFrame, frags: DataFrame, path: str) -> None:
    audit_lines(records, frags).orderBy("chunk_id").select("value").write.mode("errorifexists").text(path)


def get_record(records: DataFrame, ids: DataFrame, column: str = "record_id") -> DataFrame:
    """Each asked id with its record; a malformed id finds none."""
    held = records.withColumnsRenamed({c: f"r_{c}" for c in records.columns}).withColumn("_id", norm_id("r_record_id")).dropDuplicates(["_id"])
    return ids.withColumn("_key", uuid_key(column)).join(held, F.col("_key") == F.col("_id"), "left").drop("_key", "_id")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file on whatever file system the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(text.encode()))
    out.close()


def audit_lines(records: DataFrame, frags: DataFrame) -> DataFrame:
    """(chunk_id, value): for each fragment with records its text, then every record with its span, values and the result
    of cutting the span anew, in order of place; made on executors, a row for each fragment."""
    shown = lambda name, c: F.concat(F.lit(f"    {name}: "), F.nullif(c, F.lit("")))
    head = F.format_string("  [%s / %s / %s] offsets %d..%d, slice %s", "record_type", "tier", "verdict", "char_start", "char_end", "slice_check")
    line = F.concat_ws("\n", head, shown("span", F.to_json(F.array("evidence_span"))), shown("actor", F.col("actor")), shown("event_date", F.col("event_date")), shown("fields", F.nullif(F.col("fields"), F.lit("{}"))), shown("relevance", F.col("claim_relevance")))
    rows = export_rows(records, frags).select(norm_id("source_chunk_id").alias("chunk_id"), F.struct("char_start", "record_id", line.alias("line")).alias("r"), "page", "document")
    each = rows.groupBy("chunk_id").agg(F.array_sort(F.collect_list("r")).alias("rs"), F.first("page", True).alias("page"), F.first("document", True).alias("document"))
    texts = frags.select("chunk_id", F.col("text").alias("_t"))
    title = F.concat(F.lit("FRAGMENT "), F.col("chunk_id"), F.lit(" page "), F.coalesce(F.col("page").cast("string"), F.lit("-")), F.lit(", "), F.coalesce("document", F.lit("-")), F.lit(", "), F.size("rs").cast("string"), F.lit(" records"))
    value = F.concat_ws("\n", title, F.lit("-" * 80), F.coalesce("_t", F.lit("")), F.lit("-" * 80), F.array_join(F.transform("rs", lambda r: r["line"]), "\n"), F.lit("=" * 80))
    return each.join(texts, "chunk_id", "left").select("chunk_id", value.alias("value"))


def table_counts(tables: dict[str, DataFrame]) -> dict[str, int | str]:
    """Rows of each table; a table that can't be read says so."""
    out: dict[str, int | str] = {}
    for name, df in tables.items():
        try:
            out[name] = df.count()
        except Exception as e:  # reported, not raised: the proof of isolation goes on with the others
            out[name] = f"no access: {type(e).__name__}"
    return out


def assert_isolated(before: dict, after: dict) -> None:
    if before != after:
        raise RuntimeError(f"tables changed: {before} {after}")


def scorecards(spark: SparkSession, pattern: str, columns: list[str]) -> DataFrame:
    """All scorecards of a folder; a count that an older card lacks is 0."""
    df = spark.read.option("multiLine", "true").json(pattern)
    kinds = dict(df.dtypes)
    return df.select(*[F.coalesce(F.col(c), F.lit(0).cast(kinds[c])).alias(c) if kinds.get(c) in ("bigint", "double", "boolean") else F.col(c) if c in kinds else F.lit(0).alias(c) for c in columns])
