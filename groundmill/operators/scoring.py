"""Scores of a run: counts, rates, coverage, cross-context entities, the decisive record, faithfulness."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundmill.common import norm_id, running
from groundmill.functions.text import haystack
from groundmill.operators.entities import cross_context, reference_edges


def half_even(x: Column, digits: int) -> Column:
    """The double rounded as its exact binary value says, ties to the even digit. The error of the product with the power of
    ten is computed exactly (splitting by 2^27 + 1), so a value just above or below a tie goes the right way."""
    power = float(10**digits)
    high = power * 134217729.0 - (power * 134217729.0 - power)
    split = lambda v: (v * 134217729.0) - ((v * 134217729.0) - v)
    parts = lambda v: F.struct((v * power).alias("p"), F.floor(v * power).cast("double").alias("low"), split(v).alias("h"), (v - split(v)).alias("l"))

    def rounded(t: Column) -> Column:
        err = ((t["h"] * high - t["p"]) + t["h"] * (power - high) + t["l"] * high) + t["l"] * (power - high)
        off = t["p"] - t["low"] - 0.5
        up = (off > 0) | ((off == 0) & ((err > 0) | ((err == 0) & (t["low"] % 2 != 0))))
        return (t["low"] + F.when(up, 1.0).otherwise(0.0)) / power

    # bound as variables of a transform, so that the argument is evaluated once
    return F.transform(F.transform(F.array(x), parts), rounded)[0]


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    return half_even(F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0)), digits)


def scorecard(attempts: DataFrame, records: DataFrame, chunks_seen: int | None = None, wall_s: float = 0.0, **run: int | str) -> DataFrame:
    """One row. ``attempts``: chunk_id, located, ok, reason_code. ``records``: stored rows with verdict, flagged,
    entity_refs. ``judged`` counts the rows that reached the judge; ``chunks_seen`` counts those whose extraction failed too, so
    they are among ``chunks_empty``. ``run``: what else the run knows (label, chunks_missing, extract_errors ...)."""
    a = attempts.agg(
        F.count("*").alias("proposals"), F.count_if("located").alias("located"), F.count_if("ok").alias("records"), F.count_distinct("chunk_id").alias("chunks_with_proposals"),
        F.count_if(F.col("located") & ~F.coalesce(F.col("reason_code").isin("schema_invalid", "bad_offsets", "empty_span", "unknown_fragment", "fragment_not_found"), F.lit(False))).alias("judged"),
    )
    r = records.agg(F.count("*").alias("stored"), F.count_if(F.col("verdict") == "grounded").alias("grounded"), F.count_if("flagged").alias("flagged"))
    x = cross_context(reference_edges(records)).agg(F.count("*").alias("cross_context_entities"))
    one = a.crossJoin(r).crossJoin(x)  # three rows of one
    seen = F.lit(chunks_seen) if chunks_seen is not None else F.col("chunks_with_proposals")
    minutes = F.lit(max(wall_s, 0.0) / 60)
    per_minute = lambda c: half_even(F.when(minutes > 0, c / minutes).otherwise(0.0), 2)
    return one.withColumns({
        "chunks_empty": F.greatest(F.lit(0), seen - F.col("chunks_with_proposals")).cast("bigint"), "locate_miss": F.col("proposals") - F.col("located"),
        "pass_rate": rate(F.col("grounded"), F.col("located")), "yield_rate": rate(F.col("stored"), F.col("proposals")), "chunks_per_minute": per_minute(seen), "records_per_minute": per_minute(F.col("stored")),
        "wall_seconds": half_even(F.lit(float(max(wall_s, 0.0))), 2), "chunks_seen": seen.cast("bigint"), **{k: F.lit(v) for k, v in run.items()},
    })


def chunk_counts(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("chunk_id").agg(
        F.count("*").alias("proposals"), F.count_if("ok").alias("grounded"), F.count_if("located").alias("located"), F.count_if(F.col("located") & ~F.col("ok")).alias("bounced"), F.count_if(~F.col("located")).alias("miss"),
    )


def running_accept_rate(chunks: DataFrame, order: list[str], group: str) -> DataFrame:
    """Share of chunks with a grounded record so far, within each ``group`` (a run or a document)."""
    hit = (F.col("grounded") > 0).cast("int")
    return running(chunks, [group], order, {"done": F.lit(1), "accepted": hit}).withColumn("accept_rate", rate(F.col("accepted"), F.col("done")))


# The chunk with the decisive note, its actor, words for a change undone and for what it concerned.
GOLD_CHUNK = "89503c71-5ca2-424b-9386-6698a8337dc3"
GOLD_ACTOR = "smith"
REVERSAL_TERMS = ("revers", "revert", "reinstat", "restor", "overturn", "rescind", "reappl", "undo", "undone", "return", "placed back", "put back", "moved back", "changed back", "switched back", "back to", "back under")
GOLD_CONDITIONS = ("long covid", "mental health")


def smoking_gun(records: DataFrame, chunk: str = GOLD_CHUNK, actor: str = GOLD_ACTOR, terms: tuple[str, ...] = REVERSAL_TERMS, conditions: tuple[str, ...] = GOLD_CONDITIONS) -> DataFrame:
    """One row: whether a grounded record of the gold chunk tells of the decisive change, and the first by record_id
    with its signals. A flagged record does not count."""
    here = F.coalesce(norm_id("source_chunk_id") == chunk, F.lit(False))
    hit = decisive(records, here, re.escape(actor), list(terms), list(conditions))
    signals = F.struct(F.lit(True).alias("actor"), F.col("term").alias("reversal"), F.lit(True).alias("condition"))
    found = hit.agg(F.first(F.struct(F.col("record_id"), signals.alias("signals"))).alias("smoking_gun_detail"))
    return found.select(F.col("smoking_gun_detail").isNotNull().alias("smoking_gun"), "smoking_gun_detail")


def decisive(records: DataFrame, key: Column, actor: str, terms: list[str], conditions: list[str]) -> DataFrame:
    """First grounded record of ``key`` whose text has the actor (a pattern), a term and a condition, with the first
    of each that matches; ordered by record_id."""
    hay = haystack(F.col("evidence_span"), F.col("fields"), F.col("claim_relevance"), F.col("actor"), F.col("event_date"))
    first = lambda words: F.get(F.filter(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.contains(F.col("hay"), w)), F.lit(0))
    hits = records.filter(key & (F.col("provenance_validation.verdict") == "grounded")).withColumn("hay", hay)
    hits = hits.withColumns({"term": first(terms), "condition": first(conditions)}).filter(F.col("hay").rlike(actor) & F.col("term").isNotNull() & F.col("condition").isNotNull())
    return hits.orderBy("record_id").limit(1).select("record_id", "term", "condition")


def faithfulness(outcomes: DataFrame) -> DataFrame:
    """Totals of grounded and other outcomes; an error counts as ungrounded."""
    g = F.coalesce(F.col("grounded"), F.lit(False))
    return outcomes.agg(F.count("*").alias("total"), F.count_if(g).alias("grounded"), F.count_if(~g).alias("ungrounded")).withColumn("rate", rate(F.col("grounded"), F.col("total")))
