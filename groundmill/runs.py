"""A run of a candidate model over a list of chunks: extract, ground, store in a namespace of its own, score, export, and only then
drop. The stages are the set-based ones; a call that fails is a row with an error, counted and passed over."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.clients import Client
from groundmill.common import durable, norm_id
from groundmill.functions import jsonx
from groundmill.functions.text import normalize_actor, strip
from groundmill.operators import entities, grounding, judges, scoring
from groundmill.sources import corpus, sinks

RECORD = ["record_id", "record_type", "tier", "fields", "actor", "event_date", "claim_relevance", "confidence", "source_chunk_id", "char_start", "char_end", "page", "document", "evidence_span", "provenance_validation", "entity_refs", "flagged", "created", "supersedes"]
ATTEMPT = ["attempt_id", "chunk_id", "record_type", "tier", "located", "ok", "reason_code", "detail", "record_id"]


def extracted(chunks: DataFrame, connect: Callable[[], Client]) -> DataFrame:
    """Answers of the candidate for each chunk, with errors; written once."""
    return durable(judges.completed(chunks, judges.EXTRACT_SYSTEM, judges.extraction_prompt(F.col("text")), connect))


def proposed(answers: DataFrame) -> DataFrame:
    """A row for each usable proposal: chunk_id, n and its columns."""
    usable = answers.filter("answer_error IS NULL").select("chunk_id", F.posexplode(jsonx.proposals("answer")).alias("n", "p"))
    p = usable.select("chunk_id", "n", "p.*").withColumn("record_type", strip("record_type"))
    return p.withColumns({"tier": F.when(F.col("tier").isin(*grounding.TIERS), F.col("tier")).otherwise("fact"), "attempt_id": entities.content_id("chunk_id", F.col("n").cast("string"))})


def ground(proposals: DataFrame, frags: DataFrame, judge: Callable[[DataFrame], DataFrame], model: str, version: str, at: str) -> DataFrame:
    """Proposals with their outcome and, where accepted, everything a record holds. Ids follow from the content, so that a run
    made again gives the same."""
    df = grounding.begin(proposals.withColumn("resolved_id", norm_id("chunk_id")))
    df = grounding.cut(grounding.locate(grounding.load(df, frags)))
    df = df.withColumn("claim", grounding.claim(F.col("actor"), F.col("event_date"), F.col("fields"), F.col("claim_relevance"), F.col("tier"), F.col("record_type")))
    df = grounding.attest(grounding.gate(grounding.judged(df, judge)), model, version, at)
    who, when = normalize_actor("actor"), strip("event_date")
    refs = grounding.entity_refs(F.col("actor"), entities.content_id(F.lit("actor"), who), F.col("event_date"), entities.content_id(F.lit("date"), when))
    ok = F.col("ok")
    return df.withColumns({"located": F.col("char_start").isNotNull(), "record_id": F.when(ok, entities.content_id(F.lit("record"), "attempt_id")), "entity_refs": F.when(ok, refs), "source_chunk_id": F.col("resolved_id"), "page": F.col("source_page"), "document": F.col("source_document"), "created": F.lit(at).cast("timestamp"), "supersedes": F.lit(None).cast("string")})


def surfaces(records: DataFrame) -> DataFrame:
    """What resolve_or_create reads, of records in their order."""
    one = lambda kind, c: records.filter(F.length(c) > 0).select(F.lit(kind).alias("entity_type"), F.col(c).alias("surface"), "record_id", F.struct("created", "record_id").alias("ordinal"))
    return one("actor", "actor").unionByName(one("date", "event_date"))


def run_probe(
    spark: SparkSession, label: str, model: str, ids: DataFrame, frags: DataFrame, connect: Callable[[], Client], judge: Callable[[DataFrame], DataFrame], out: str,
    protected: dict[str, DataFrame] | None = None, judge_model: str = "judge", judge_version: str = "1", at: str | None = None, drop_after: bool = True, emit: Callable[[str], None] = print,
) -> dict:
    """Scorecard and isolation of a run; under ``out`` are attempts, run_meta, scorecard, records, audit and isolation.

    The namespace is dropped only when both score and export are written; tables of ``protected`` must be as before, else
    the run ends with an error. ``ids``: chunk_id."""
    at = at or time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime())
    before, schema, saved, begun = sinks.table_counts(protected or {}), sinks.create_namespace(spark, label), False, time.monotonic()
    card: dict | None = None
    try:
        looked = durable(corpus.lookup(ids.select("chunk_id"), frags))
        asked = looked.agg(F.count("*").alias("n"), F.count_if("found").alias("seen")).head()
        emit(f"begin {asked['n']} chunks, {asked['n'] - asked['seen']} missing | {model} into {schema}")
        answers = extracted(looked.filter("found").select(F.col("f_chunk_id").alias("chunk_id"), F.col("f_text").alias("text")).dropDuplicates(["chunk_id"]), connect)
        errors = answers.filter("answer_error IS NOT NULL").count()
        tried = durable(ground(proposed(answers), frags, judge, judge_model, judge_version, at))
        tried.filter("ok").select(*RECORD).write.saveAsTable(f"{schema}.enrichment_records")
        records = spark.table(f"{schema}.enrichment_records")
        entities.resolve_or_create(surfaces(records)).write.saveAsTable(f"{schema}.codex_entities")
        wall = max(0.0, time.monotonic() - begun)
        tried.select(*ATTEMPT).write.mode("errorifexists").json(f"{out}/attempts")
        run = {"label": label, "candidate_model": model, "chunks_missing": asked["n"] - asked["seen"], "extract_errors": errors}
        rows = records.withColumn("verdict", F.col("provenance_validation.verdict"))
        one = scoring.scorecard(tried, rows, asked["seen"], wall, **run).crossJoin(scoring.smoking_gun(records))  # one row each
        card = one.head().asDict(recursive=True)
        meta = run | {"schema": schema, "chunks": asked["n"], "chunks_seen": asked["seen"], "wall_seconds": round(wall, 2), "records_written": card["stored"], "at": at}
        sinks.write_text(spark, f"{out}/run_meta.json", json.dumps(meta, indent=1))
        sinks.write_text(spark, f"{out}/scorecard.json", json.dumps(card, indent=1))
        sinks.export_jsonl(records, frags, f"{out}/records")
        sinks.export_audit(rows, frags, f"{out}/audit")
        saved = True
    finally:
        after = sinks.table_counts(protected or {})
        proof = {"untouched": before == after, "before": before, "after": after, "scored_and_exported": saved}
        sinks.write_text(spark, f"{out}/isolation.json", json.dumps(proof, indent=1))
        if saved and drop_after:
            sinks.drop_namespace(spark, label)
        elif not saved:
            emit(f"{schema} is kept: it was not scored and exported")
    sinks.assert_isolated(before, after)
    emit(f"end {card['stored']} records of {card['proposals']} proposals, {errors} failed extractions")
    return {"scorecard": card, **proof}
