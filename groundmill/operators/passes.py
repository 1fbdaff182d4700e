"""Passes over all chunks, one DataFrame each: vocabularies, consolidation, keywords, retries that level off."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundmill.functions.jsonx import cleaned_keywords
from groundmill.functions.text import clean_keyword, normalize_type


def vocabulary(chunks: DataFrame, terms: str) -> DataFrame:
    """Sorted distinct terms of all chunks."""
    return chunks.select(F.explode(terms).alias("term")).distinct().orderBy("term")


def consolidate(vocab: DataFrame, mapping: DataFrame) -> DataFrame:
    """Canonical term of each; a term without mapping stands for itself."""
    m = mapping.select(F.col("raw").alias("_raw"), "canonical").dropDuplicates(["_raw"])
    return vocab.join(m, F.col("term") == F.col("_raw"), "left").select("term", F.coalesce(normalize_type("canonical"), "term").alias("canonical"))


def clean_chunks(chunks: DataFrame, words: str = "keywords") -> DataFrame:
    """Cleaned keywords of each chunk; a chunk with none left stays, with an empty list."""
    return chunks.withColumn("cleaned", F.coalesce(cleaned_keywords(words), F.array().cast("array<string>")))


def clean_map(chunks: DataFrame, words: str = "keywords") -> DataFrame:
    return chunks.select(F.explode(words).alias("raw")).distinct().select("raw", clean_keyword("raw").alias("cleaned"))


def plateau(tries: DataFrame, key: str = "chunk_id", eps: float = 0.05, cap: int = 25) -> DataFrame:
    """First try of each chunk whose confidence does not better the best before it by ``eps``; null where it goes
    on to the cap. ``tries``: key, n from 1, confidence; NaN counts as 0."""
    c = F.when(F.isnan("confidence"), 0.0).otherwise(F.col("confidence"))
    before = Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    t = tries.filter(F.col("n") <= cap).withColumn("_c", c).withColumn("_best", F.max("_c").over(before))
    stop = F.when((F.col("n") > 1) & (F.col("_c") < F.col("_best") + eps), F.col("n"))
    return t.groupBy(key).agg(F.min(stop).alias("stopped_at"), F.max("_c").alias("best_confidence"), F.count("*").alias("tries"))


def review(inputs: DataFrame, **passes: DataFrame) -> DataFrame:
    """Inputs with the outcome of every pass, by chunk_id; each pass has one row for a chunk at most."""
    for name, p in passes.items():
        p = p.dropDuplicates(["chunk_id"])
        inputs = inputs.join(p.select(F.col("chunk_id").alias("_c"), F.struct(*[c for c in p.columns if c != "chunk_id"]).alias(name)), F.col("chunk_id") == F.col("_c"), "left").drop("_c")
    return inputs
