"""Reading the corpus: fragments by id, by neighbourhood, by page, by list, and slices put together of them.

Every reader is DataFrame in, DataFrame out, so predicates and columns reach the scan. Ids compare in normal form.
Missing fragments are rows with ``found`` false where the reader reports them, never errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundmill.common import broadcast_if_small, norm_id, running
from groundmill.functions.text import any_id, page_range, uuid_key

FRAGMENT = ["chunk_id", "text", "document", "page", "chunk_type", "segment_index"]


def fragments(corpus: DataFrame) -> DataFrame:
    """One row for each fragment in the words of the domain; a null text is an empty one."""
    return corpus.select(norm_id("chunk_id").alias("chunk_id"), F.coalesce("text", F.lit("")).alias("text"), "document", "page", "chunk_type", "segment_index").dropDuplicates(["chunk_id"])


def fragments_of_payload(corpus: DataFrame) -> DataFrame:
    """The same from a corpus that keeps its text in a JSON payload."""
    text = F.coalesce(F.get_json_object("payload", "$.chunk_text"), F.lit(""))
    return corpus.select(norm_id("claim_chunk_id").alias("chunk_id"), text.alias("text"), F.col("document_name").alias("document"), F.col("page_number").alias("page"), "chunk_type", "segment_index")


def lookup(ids: DataFrame, frags: DataFrame, column: str = "chunk_id") -> DataFrame:
    """Each asked id with its fragment; malformed ids are not looked up."""
    asked = ids.withColumn("_key", uuid_key(column))
    got = frags.withColumnsRenamed({c: f"f_{c}" for c in frags.columns})
    return asked.join(got, F.col("_key") == F.col("f_chunk_id"), "left").withColumn("found", F.col("f_chunk_id").isNotNull()).drop("_key")


def neighbours(anchors: DataFrame, frags: DataFrame, window: int = 1, order: str = "segment_index") -> DataFrame:
    """(anchor_id, fragment columns) of the same document within ``window`` places, the anchor included. Places
    are cut into bands as wide as the window, and a fragment is sent to the bands it can lie in: an
    equi join, which a huge document does not gather in one task."""
    span = max(window, 0) * 2 + 1
    base = frags.join(anchors.select(any_id("chunk_id").alias("chunk_id")).distinct(), "chunk_id", "left_semi")
    a = base.select(F.col("chunk_id").alias("anchor_id"), F.col("document").alias("_doc"), F.col(order).alias("_at"), F.floor(F.col(order) / span).alias("_band")).filter(F.lit(window >= 0))
    b = frags.withColumn("_in", F.explode(F.array_distinct(F.array(*[F.floor((F.col(order) + d) / span) for d in (-window, 0, window)]))))
    near = F.col(order).between(F.col("_at") - window, F.col("_at") + window)
    return a.join(b, (F.col("_doc") == F.col("document")) & (F.col("_band") == F.col("_in")) & near).drop("_doc", "_at", "_band", "_in")


def by_ids(frags: DataFrame, ids: DataFrame) -> DataFrame:
    return frags.join(broadcast_if_small(ids.select(norm_id("chunk_id").alias("chunk_id")).distinct()), "chunk_id", "left_semi")


def in_pages(frags: DataFrame, lo: Column | int, hi: Column | int) -> DataFrame:
    """All documents' fragments of the pages lo to hi."""
    return frags.filter(F.col("page").between(lo, hi))


def in_file_pages(frags: DataFrame, names: DataFrame) -> DataFrame:
    """Fragments of the page ranges that file names give, with the name as source. A range is cut at the corpus' last page
    and taken apart into its pages, so both sides meet in an equi join, of any number of names."""
    asked = names.select("name", page_range("name").alias("r")).filter("r.lo IS NOT NULL")
    last = frags.agg(F.max("page").alias("_last"))  # one row
    asked = asked.crossJoin(F.broadcast(last)).withColumn("_hi", F.least("r.hi", "_last")).filter("r.lo <= _hi")
    pages = asked.select("name", F.explode(F.sequence("r.lo", "_hi")).alias("page"))
    return frags.join(pages, "page").withColumn("source", F.concat(F.lit("pdf:"), "name")).drop("name").select(*frags.columns, "source")


def listed_ids(lines: DataFrame, strip_first: bool = True) -> DataFrame:
    """(chunk_id, ordinal) of a list with an id at the beginning of each line; # begins a remark. ``lines``: value,
    ordinal. A remark behind blanks counts as one only with ``strip_first``."""
    v = F.trim("value")
    remark = v.startswith("#") if strip_first else F.col("value").startswith("#")
    return lines.filter((v != "") & ~remark).select(F.split(v, r"\s+")[0].alias("chunk_id"), "ordinal")


def listed(frags: DataFrame, lines: DataFrame, keep_missing: bool = False) -> DataFrame:
    """Fragments of a list in its order."""
    ids = listed_ids(lines).withColumn("chunk_id", norm_id("chunk_id"))
    return ids.join(frags, "chunk_id", "left" if keep_missing else "inner").orderBy("ordinal")


def slice_of(frags: DataFrame, gold: DataFrame, pages: DataFrame, terms: list[str]) -> DataFrame:
    """Distinct ids of gold fragments, of fragments on seed pages and of fragments with any term, in order."""
    by_page = frags.join(broadcast_if_small(pages.select("page").distinct()), "page", "left_semi").select("chunk_id")
    hit = reduce(lambda x, y: x | y, [F.col("text").ilike(f"%{t}%") for t in terms], F.lit(False))
    return gold.select(norm_id("chunk_id").alias("chunk_id")).union(by_page).union(frags.filter(hit).select("chunk_id")).distinct()


def first_source(*sources: DataFrame) -> DataFrame:
    """Union of sources in order of precedence: a fragment stays with the first that has it. Each has chunk_id,
    source and ordinal."""
    every = reduce(lambda a, b: a.unionByName(b), [s.withColumn("_p", F.lit(i)) for i, s in enumerate(sources)])
    rank = F.row_number().over(Window.partitionBy("chunk_id").orderBy("_p", "ordinal"))
    return every.withColumn("_n", rank).filter("_n = 1").drop("_n", "_p")


def first_seen_handles(mentions: DataFrame) -> DataFrame:
    """Handles F1, F2 … of fragments in the order in which a workstream first saw them. ``mentions``: workstream,
    chunk_id, ordinal."""
    first = mentions.groupBy("workstream", "chunk_id").agg(F.min("ordinal").alias("first"))
    n = running(first, ["workstream"], ["first", "chunk_id"], {"n": F.lit(1)})
    return n.withColumn("handle", F.concat(F.lit("F"), F.col("n").cast("string"))).drop("n")
