"""Queries of the training-data problems and, where SQL can express them, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.common import durable, norm_id, table
from groundmill.llm import groups, mixing, names, pii, subjects, tokenizer, vectors


def name_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name of an actor row and of a record: ref is 'e:' and the entity or 'r:' and the record ('a:' where
    the record already has an actor, which is evidence only)."""
    claims = F.coalesce(F.from_json("metadata", "claims ARRAY<STRING>")["claims"], F.array().cast("array<string>"))
    entities = table(spark, sf_dir, "codex_entities").filter("entity_type = 'actor'")
    entities = entities.select(F.concat(F.lit("e:"), norm_id("entity_id")).alias("ref"), F.explode(F.array_union(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"), claims.alias("contexts"))
    attached = F.coalesce(F.exists("entity_refs", lambda r: F.lower(F.trim(r["role"])) == "actor"), F.lit(False))
    claim = F.regexp_extract("document", r"^([A-Za-z]+-\d+)", 1)
    records = table(spark, sf_dir, "enrichment_records").filter("actor IS NOT NULL").select(F.concat(F.when(attached, "a:").otherwise("r:"), norm_id("record_id")).alias("ref"), F.col("actor").alias("name"), F.array(claim).alias("contexts"))
    return entities.unionByName(records).filter("name IS NOT NULL").distinct()


def p1_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ref, person) of actor rows and of records without actor reference."""
    return names.link_names(name_mentions(spark, sf_dir)).filter(~F.col("ref").startswith("a:"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = durable(p1_links(spark, sf_dir).select(F.substring("ref", 1, 1).alias("kind"), F.expr("substring(ref, 3)").alias("key"), "person"))
    entity = linked.filter("kind = 'e'").select(F.col("key").alias("x"), "person")
    pairs = entity.join(linked.select(F.col("key").alias("y"), "kind", F.col("person").alias("of")), (F.col("person") == F.col("of")) & (F.col("x") != F.col("y")))
    return pairs.select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).distinct()


def p3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "enrichment_meaning").select(norm_id("meaning_id").alias("meaning_id"), "embedding")
    return vectors.similar_vectors(rows, "meaning_id", "embedding", k=5, least=0.8)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = p3_neighbours(spark, sf_dir)
    return near.select(F.least("id", "other").alias("meaning_a"), F.greatest("id", "other").alias("meaning_b")).distinct()


def same_event_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of same_event links that both exist; ids in normal form."""
    reads = F.regexp_replace(F.lower("relation"), r"(?U)[\s_-]+", "") == "sameevent"
    links = table(spark, sf_dir, "enrichment_links").filter(reads).select(norm_id("record_a").alias("a"), norm_id("record_b").alias("b")).filter("a <> b").distinct()
    ids = table(spark, sf_dir, "enrichment_records").select(norm_id("record_id").alias("id")).distinct()
    return links.join(ids.withColumnRenamed("id", "a"), "a", "left_semi").join(ids.withColumnRenamed("id", "b"), "b", "left_semi")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.connected_groups(same_event_edges(spark, sf_dir), "a", "b").select(F.col("vertex").alias("record_id"), F.col("group").alias("group_id"))


def p4_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = p4_found(spark, sf_dir).groupBy("group_id").agg(F.count("*").alias("records"))
    return sizes.groupBy("records").agg(F.count("*").alias("groups"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer.token_ids(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p7_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = tokenizer.token_counts(table(spark, sf_dir, "documents").select("source", "text"))
    return sized.groupBy("source").agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"), F.max("n_tokens").alias("longest"))


def sized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return durable(tokenizer.token_counts(docs).select("doc_id", "source", "n_tokens"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(sized_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(sized_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[1]


def found_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = subjects.train(docs, table(spark, sf_dir, "subject_labels"), table(spark, sf_dir, "subject_areas"))
    return subjects.subject_areas(docs.select("doc_id", "text"), models)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_subjects(spark, sf_dir).select("doc_id", F.explode("subjects").alias("subject"))


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and characters of the corpus by subject; a document of several counts for each."""
    rows = found_subjects(spark, sf_dir).select(F.explode_outer("subjects").alias("subject"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    return rows.groupBy(F.coalesce("subject", F.lit("none")).alias("subject")).agg(F.count("*").alias("documents"), F.sum("chars").alias("chars"))


def pii_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its items: fragments and evidence spans."""
    fragments = table(spark, sf_dir, "fragments").select(F.lit("fragments").alias("source_table"), norm_id("chunk_id").alias("row_key"), "text")
    records = table(spark, sf_dir, "enrichment_records").select(F.lit("enrichment_records").alias("source_table"), norm_id("record_id").alias("row_key"), F.col("evidence_span").alias("text"))
    return pii.personal_items(fragments.unionByName(records), "text")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_rows(spark, sf_dir).select("source_table", "row_key", F.explode("items").alias("i")).select("source_table", "row_key", "i.*").distinct()


def p6_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redact(pii_rows(spark, sf_dir), "text").select("source_table", "row_key", "redacted").distinct()


_N = r"regexp_replace(regexp_replace(lower({0}), '^[\s{{}}]+', ''), '[\s{{}}]+$', '')".format
_P4 = f"""
WITH RECURSIVE ids AS (SELECT DISTINCT {_N('record_id')} AS id FROM enrichment_records),
e AS (
  SELECT DISTINCT {_N('record_a')} AS a, {_N('record_b')} AS b FROM enrichment_links
  WHERE regexp_replace(lower(relation), '[\\s_-]+', '', 'g') = 'sameevent'
), good AS (SELECT a, b FROM e WHERE a <> b AND a IN (SELECT id FROM ids) AND b IN (SELECT id FROM ids)),
both_ways AS (SELECT a, b FROM good UNION SELECT b, a FROM good),
reach(x, y) AS (SELECT a, a FROM both_ways UNION SELECT r.x, w.b FROM reach r JOIN both_ways w ON r.y = w.a),
found AS (SELECT x AS record_id, min(y) AS group_id FROM reach GROUP BY x)
"""
_P3 = f"""
WITH m AS (SELECT DISTINCT ON (id) {_N('meaning_id')} AS id, embedding::DOUBLE[] AS v FROM enrichment_meaning WHERE len(embedding) = 64 AND list_max(embedding) - list_min(embedding) + abs(list_max(embedding)) > 0),
c AS (SELECT a.id, b.id AS other, round(list_cosine_similarity(a.v, b.v), 6) AS cos FROM m a JOIN m b ON a.id <> b.id),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cos DESC, other) AS n FROM c) WHERE n <= 5 AND cos >= 0.8)
"""
QUERIES = {
    "p1_found": p1_found,
    "p3_found": p3_found, "p3_neighbours": p3_neighbours, "p4_found": p4_found, "p4_sizes": p4_sizes, "p7_ids": p7_ids, "p7_counts": p7_counts, "p8_mix": p8_mix, "p8_shares": p8_shares, "p9_found": p9_found, "p9_composition": p9_composition, "p6_found": p6_found, "p6_redacted": p6_redacted,
}
ORACLES = {
    "p3_neighbours": _P3 + "SELECT id, other, cos FROM near",
    "p3_found": _P3 + "SELECT DISTINCT least(id, other) AS meaning_a, greatest(id, other) AS meaning_b FROM near",
    "p4_found": _P4 + "SELECT * FROM found",
    "p4_sizes": _P4 + "SELECT records, count(*) AS groups FROM (SELECT group_id, count(*) AS records FROM found GROUP BY 1) GROUP BY 1",
}
