"""Queries of the general data problems: times as found (p2) and references to missing rows (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.common import norm_id, table
from groundmill.operators import references, timestamps


def dated_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_table, row_key, event_date, office): one row per record and proposal that has a value."""
    records = table(spark, sf_dir, "enrichment_records").select(F.lit("enrichment_records").alias("source_table"), norm_id("record_id").alias("row_key"), norm_id("source_chunk_id").alias("chunk"), "event_date")
    proposals = table(spark, sf_dir, "extraction_proposals").select(F.lit("extraction_proposals").alias("source_table"), norm_id("proposal_id").alias("row_key"), norm_id("chunk_id").alias("chunk"), "event_date")
    values = records.unionByName(proposals).filter(F.col("event_date").isNotNull() & F.col("row_key").isNotNull()).dropDuplicates(["source_table", "row_key"])
    office = table(spark, sf_dir, "fragments").select(norm_id("chunk_id").alias("chunk"), F.substring("claim_id", 1, 3).alias("office")).filter(F.col("chunk").isNotNull()).dropDuplicates(["chunk"])
    return values.join(office, "chunk", "left").drop("chunk")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = timestamps.normalise_times(dated_values(spark, sf_dir), table(spark, sf_dir, "offices"))
    return out.filter(F.col("event_norm").isNotNull()).select("source_table", "row_key", "event_norm")


def p2_ambiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How values were read where no order is declared: the mixture alone decides, office by office."""
    out = timestamps.normalise_times(dated_values(spark, sf_dir), table(spark, sf_dir, "offices"), use_declared=False)
    return out.groupBy("office", "precision", "ambiguity").agg(F.count("*").alias("rows"))


def found_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference with its kind; the key in lower case without blanks around and braces."""
    month = F.date_format("created", "yyyy-MM")
    links = table(spark, sf_dir, "enrichment_links")
    links = links.select(
        F.lit("enrichment_links").alias("source_table"), norm_id("link_id").alias("row_key"), month.alias("period"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("ref_field"), F.lit(k).alias("kind"), norm_id(f).alias("key")) for f, k in (("record_a", "record"), ("record_b", "record"), ("event_entity", "entity"))])).alias("r"),
    )
    entities = table(spark, sf_dir, "codex_entities").select(
        F.lit("codex_entities").alias("source_table"), norm_id("entity_id").alias("row_key"), month.alias("period"), F.struct(F.lit("first_seen_record").alias("ref_field"), F.lit("record").alias("kind"), norm_id("first_seen_record").alias("key")).alias("r")
    )
    records = table(spark, sf_dir, "enrichment_records").select(
        F.lit("enrichment_records").alias("source_table"), norm_id("record_id").alias("row_key"), month.alias("period"),
        F.explode(F.transform("entity_refs", lambda x: F.struct(F.lit("entity_refs").alias("ref_field"), F.lit("entity").alias("kind"), norm_id(x["entity_id"]).alias("key")))).alias("r"),
    )
    return links.unionByName(entities).unionByName(records).select("source_table", "row_key", "period", "r.*")


def reference_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda name, key, kind: table(spark, sf_dir, name).select(F.lit(kind).alias("kind"), norm_id(key).alias("key"))
    return of("enrichment_records", "record_id", "record").unionByName(of("codex_entities", "entity_id", "entity")).unionByName(of("codex_shared", "entity_id", "entity"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = references.orphans(found_references(spark, sf_dir), reference_targets(spark, sf_dir), ["kind", "key"])
    return found.select("source_table", "row_key", "ref_field", F.col("key").alias("missing_key"), "period").distinct()


def place_references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records refer to a place in a file, (document, page), of which either may be unknown; targets are the places of fragments."""
    refs = table(spark, sf_dir, "enrichment_records").select(norm_id("record_id").alias("record_id"), "document", "page").dropDuplicates(["record_id"])
    return refs, table(spark, sf_dir, "fragments").select("document", "page")


def p5_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan places under partial match: what is known of the place must agree with some fragment."""
    return references.orphans(*place_references(spark, sf_dir), ["document", "page"], "partial")


def p5_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan places under full match: a place known in part is an orphan at once."""
    return references.orphans(*place_references(spark, sf_dir), ["document", "page"], "full")


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.report(p5_found(spark, sf_dir))


_NORM = r"regexp_replace(regexp_replace(lower({0}), '^[\s{{}}]+', ''), '[\s{{}}]+$', '')"
_N = lambda c: _NORM.format(c)
_P5 = f"""
WITH refs AS (
  SELECT 'enrichment_links' AS source_table, {_N('link_id')} AS row_key, created, 'record_a' AS ref_field, 'record' AS kind, {_N('record_a')} AS key FROM enrichment_links
  UNION ALL SELECT 'enrichment_links', {_N('link_id')}, created, 'record_b', 'record', {_N('record_b')} FROM enrichment_links
  UNION ALL SELECT 'enrichment_links', {_N('link_id')}, created, 'event_entity', 'entity', {_N('event_entity')} FROM enrichment_links
  UNION ALL SELECT 'codex_entities', {_N('entity_id')}, created, 'first_seen_record', 'record', {_N('first_seen_record')} FROM codex_entities
  UNION ALL SELECT 'enrichment_records', {_N('record_id')}, created, 'entity_refs', 'entity', {_N('ref.entity_id')} FROM (SELECT record_id, created, unnest(entity_refs) AS ref FROM enrichment_records)
), targets AS (
  SELECT 'record' AS kind, {_N('record_id')} AS key FROM enrichment_records
  UNION SELECT 'entity', {_N('entity_id')} FROM codex_entities
  UNION SELECT 'entity', {_N('entity_id')} FROM codex_shared
), found AS (
  SELECT DISTINCT source_table, row_key, ref_field, key AS missing_key, strftime(created AT TIME ZONE 'UTC', '%Y-%m') AS period
  FROM refs r WHERE key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM targets t WHERE t.kind = r.kind AND t.key = r.key)
)
"""
_PLACES = f"WITH r AS (SELECT DISTINCT ON (record_id) {_N('record_id')} AS record_id, document, page FROM enrichment_records)"
QUERIES = {"p2_found": p2_found, "p2_ambiguity": p2_ambiguity, "p5_found": p5_found, "p5_report": p5_report, "p5_partial": p5_partial, "p5_full": p5_full}
ORACLES = {
    "p5_partial": _PLACES + " SELECT * FROM r WHERE coalesce(document, page::VARCHAR) IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fragments f WHERE (r.document IS NULL OR f.document = r.document) AND (r.page IS NULL OR f.page = r.page))",
    "p5_full": _PLACES + " SELECT * FROM r WHERE (document IS NULL) <> (page IS NULL) OR document IS NOT NULL AND page IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fragments f WHERE f.document = r.document AND f.page = r.page)",
    "p5_found": _P5 + "SELECT * FROM found",
    "p5_report": _P5 + "SELECT source_table, ref_field, period, count(*) AS orphan_refs, count(DISTINCT missing_key) AS missing_keys FROM found GROUP BY ALL",
}
