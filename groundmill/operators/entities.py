"""Shared nouns: resolve-or-create as grouping, reverse lookup, weight, co-occurrence, candidate pairs, walks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.common import durable, norm_id, running
from groundmill.functions.text import normalize_actor, strip
from groundmill.sources import corpus

ENTITY_TYPES = ("actor", "date", "code", "provision", "document", "event")


def content_id(*columns: str):
    """A uuid-shaped id of the content, so that a replay gives the same ids."""
    h = F.md5(F.concat_ws("\x1f", *columns))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def resolve_or_create(surfaces: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row for each (entity_type, canonical): first_seen_record is the first record in order, aliases are the
    other surfaces in the order they were first seen, behind those of ``existing``. Never merges by likeness.

    ``surfaces``: entity_type, surface, record_id, ordinal. Surfaces are aggregated to distinct ones first, so a noun
    of a third of the rows is folded before it is gathered."""
    canonical = F.when(F.col("entity_type") == "actor", normalize_actor("surface")).otherwise(strip("surface"))
    named = surfaces.filter(F.length("surface") > 0).withColumn("canonical", canonical)
    by_surface = named.groupBy("entity_type", "canonical", "surface").agg(F.min(F.struct("ordinal", "record_id")).alias("first"))
    order = F.array_sort(F.collect_list(F.when(F.col("surface") != F.col("canonical"), F.struct("first", "surface"))))
    new = by_surface.groupBy("entity_type", "canonical").agg(F.min("first")["record_id"].alias("first_seen_record"), F.transform(order, lambda x: x["surface"]).alias("aliases"))
    new = new.withColumn("entity_id", content_id("entity_type", "canonical"))
    if existing is None:
        return new.select("entity_id", "entity_type", "canonical", "aliases", "first_seen_record")
    old = existing.select("entity_id", "entity_type", "canonical", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), "first_seen_record")
    j = old.alias("o").join(new.alias("n"), ["entity_type", "canonical"], "full")
    empty = F.array().cast("array<string>")
    return j.select(
        F.coalesce("o.entity_id", "n.entity_id").alias("entity_id"), "entity_type", "canonical",
        F.array_distinct(F.concat(F.coalesce("o.aliases", empty), F.coalesce("n.aliases", empty))).alias("aliases"), F.when(F.col("o.entity_id").isNotNull(), F.col("o.first_seen_record")).otherwise(F.col("n.first_seen_record")).alias("first_seen_record"),
    )


def by_chunk(records: DataFrame, columns: list) -> DataFrame:
    """(chunk_id, records): the chosen columns of each chunk's records in order of place. A chunk holds few records."""
    first = [F.col("char_start").alias("_at")]
    r = records.select(norm_id("source_chunk_id").alias("chunk_id"), F.struct(*first, *columns).alias("r")).filter("chunk_id IS NOT NULL")
    return r.groupBy("chunk_id").agg(F.array_sort(F.collect_list("r")).alias("records"))


def reference_edges(records: DataFrame) -> DataFrame:
    """(record_id, chunk_id, entity_id), distinct: the one explode that reverse lookups share."""
    e = records.select(norm_id("record_id").alias("record_id"), norm_id("source_chunk_id").alias("chunk_id"), F.explode("entity_refs").alias("r"))
    return e.select("record_id", "chunk_id", norm_id("r.entity_id").alias("entity_id")).filter("entity_id IS NOT NULL").distinct()


def weights(edges: DataFrame, theme_share: float = 0.05) -> DataFrame:
    """Distinct fragments for each entity; a theme is in more than ``theme_share`` of all fragments."""
    per = edges.groupBy("entity_id").agg(F.count_distinct("chunk_id").alias("weight"))
    whole = edges.agg(F.count_distinct("chunk_id").alias("chunks"))
    return per.crossJoin(F.broadcast(whole)).select("entity_id", "weight", (F.col("weight") >= F.greatest(F.lit(2), F.ceil(F.col("chunks") * theme_share))).alias("is_theme"))


def cross_context(edges: DataFrame) -> DataFrame:
    """Entities that records of two fragments or more refer to."""
    return edges.groupBy("entity_id").agg(F.count_distinct("chunk_id").alias("chunks")).filter("chunks >= 2")


def cooccurrence(edges: DataFrame, part: int = 200) -> DataFrame:
    """(entity_id, other_id, records, chunks): how many records and chunks two entities share; a row for each direction.
    Themes are counted too. A place with more than ``part`` entities is cut into parts, so that no task pairs it alone."""
    counts = []
    for place, other in (("record_id", "chunk_id"), ("chunk_id", "record_id")):
        e = edges.filter(F.col(place).isNotNull()).select(F.col(place).alias("place"), "entity_id").distinct()
        e = e.join(e.groupBy("place").agg(F.floor(F.count("*") / part).cast("int").alias("parts")), "place")
        a = e.select("place", F.col("entity_id").alias("a"), F.pmod(F.hash("entity_id"), F.col("parts") + 1).alias("part"))
        b = e.select("place", F.col("entity_id").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts"))).alias("part"))
        pairs = a.join(b, ["place", "part"]).filter("a < b").groupBy("a", "b").agg(F.count("*").alias(place)).withColumn(other, F.lit(0).cast("bigint"))
        counts.append(pairs.select("a", "b", F.col("record_id").alias("records"), F.col("chunk_id").alias("chunks")))
    both = counts[0].unionByName(counts[1]).groupBy("a", "b").agg(F.sum("records").alias("records"), F.sum("chunks").alias("chunks"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
    return both.select(ways.alias("w"), "records", "chunks").select(F.col("w.x").alias("entity_id"), F.col("w.y").alias("other_id"), "records", "chunks")


def candidate_pairs(edges: DataFrame, fan_out: int = 20) -> DataFrame:
    """Pairs of records that share an entity that is no theme, each record with its next ``fan_out`` of the entity
    in order of id. The cap is the operator's meaning. Records of an entity are numbered and meet by number, so no group
    of all its pairs is made."""
    return _meetings(edges, fan_out).groupBy("record_a", "record_b").agg(F.count("*").alias("shared"))


def _meetings(edges: DataFrame, fan_out: int) -> DataFrame:
    """The same, once for each entity."""
    w = weights(edges).filter("NOT is_theme").select("entity_id")
    kept = edges.join(w, "entity_id", "left_semi").select("record_id", "entity_id").distinct()
    n = running(kept, ["entity_id"], ["record_id"], {"n": F.lit(1)})
    ahead = n.withColumn("n", F.explode(F.sequence(F.col("n") + 1, F.col("n") + fan_out))).withColumnRenamed("record_id", "record_a")
    return ahead.join(n.withColumnRenamed("record_id", "record_b"), ["entity_id", "n"]).select("record_a", "record_b")


def fan_out_cut(edges: DataFrame, fan_out: int = 20) -> DataFrame:
    """What the cap of ``candidate_pairs`` leaves out: (entity_id, records, pairs, cut) of each entity that is no theme."""
    w = weights(edges).filter("NOT is_theme").select("entity_id")
    n = edges.join(w, "entity_id", "left_semi").groupBy("entity_id").agg(F.count_distinct("record_id").alias("records"))
    pairs = F.expr("records * (records - 1) div 2")
    beyond = F.expr(f"(greatest(records - {fan_out}, 1L) - 1) * (greatest(records - {fan_out}, 1L)) div 2")
    return n.select("entity_id", "records", pairs.alias("pairs"), beyond.alias("cut"))


def document_adjacent(records: DataFrame, frags: DataFrame, window: int = 1) -> DataFrame:
    """Distinct pairs of records of fragments of one document within ``window`` places, those of the same fragment included. Records
    whose fragment is unknown have no place. Not capped: fragments hold few records."""
    return _adjacent(records, frags, window).distinct()


def _adjacent(records: DataFrame, frags: DataFrame, window: int) -> DataFrame:
    r = records.select(norm_id("record_id").alias("record_id"), norm_id("source_chunk_id").alias("chunk_id")).distinct()
    near = corpus.neighbours(r.select("chunk_id"), frags, window).select("anchor_id", "chunk_id")
    a, b = r.withColumnsRenamed({"record_id": "record_a", "chunk_id": "anchor_id"}), r.withColumnRenamed("record_id", "record_b")
    return a.join(near, "anchor_id").join(b, "chunk_id").filter("record_a < record_b").select("record_a", "record_b")


def candidates(records: DataFrame, frags: DataFrame, fan_out: int = 20, window: int = 1) -> DataFrame:
    """(record_a, record_b, shared, adjacent): the pairs of ``candidate_pairs`` and of ``document_adjacent``, each once."""
    shared = _meetings(reference_edges(records), fan_out).withColumns({"shared": F.lit(1), "adjacent": F.lit(False)})
    near = _adjacent(records, frags, window).withColumns({"shared": F.lit(0), "adjacent": F.lit(True)})
    return shared.unionByName(near).groupBy("record_a", "record_b").agg(F.sum("shared").alias("shared"), F.bool_or("adjacent").alias("adjacent"))


def walk(start: DataFrame, edges: DataFrame, links: DataFrame, records: DataFrame, steps: int = 2) -> DataFrame:
    """(record_id, steps): chunk -> entities -> records -> links -> records. ``start`` has any of chunk_id, entity_id and
    record_id. Step 0 has the given records and those that refer to a given entity or to one of a given chunk
    (``edges``); from there links are followed in either direction up to ``steps``. Only ``records`` that exist are reached,
    each with the fewest steps."""
    seed = lambda c: start.select(norm_id(c).alias(c)).dropna().distinct() if c in start.columns else None
    chunks, nouns, given = (seed(c) for c in ("chunk_id", "entity_id", "record_id"))
    named = [nouns] if nouns is not None else []
    if chunks is not None:
        named.append(edges.join(chunks, "chunk_id", "left_semi").select("entity_id"))
    first = [given] if given is not None else []
    if named:
        first.append(edges.join(reduce(DataFrame.union, named).distinct(), "entity_id", "left_semi").select("record_id"))
    if not first:
        raise ValueError("start must have chunk_id, entity_id or record_id")
    known = records.select(norm_id("record_id").alias("record_id")).distinct()
    pairs = links.select(norm_id("record_a").alias("x"), norm_id("record_b").alias("y")).filter("x <> y")
    pairs = durable(pairs.union(pairs.select("y", "x")).distinct())
    seen = front = durable(reduce(DataFrame.union, first).distinct().join(known, "record_id", "left_semi").withColumn("steps", F.lit(0)))
    for step in range(1, steps + 1):
        front = durable(front.join(pairs, F.col("record_id") == F.col("x")).select(F.col("y").alias("record_id")).distinct().join(known, "record_id", "left_semi").join(seen, "record_id", "left_anti").withColumn("steps", F.lit(step)))
        seen = seen.unionByName(front)
    return seen
