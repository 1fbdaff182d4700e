"""Passes over all chunks as stages: each takes the chunks and what came before it and gives a table.

A stage is either by chunk (one row for each chunk, with an error column where its call failed) or whole. ``run_stages``
writes every stage's table as soon as it is there and reads it again, so nothing is asked of the model twice and a run that
breaks off keeps what it had."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundmill.clients import Client
from groundmill.common import durable
from groundmill.functions import jsonx
from groundmill.functions.text import normalize_type, parse_prose_label
from groundmill.operators import grounding, judges, passes

Connect = Callable[[], Client]


@dataclass
class Context:
    """What stages share: the model, the judge of filled records, limits of the retries."""

    connect: Connect
    judge: Callable[[DataFrame], DataFrame] | None = None
    eps: float = 0.05
    cap: int = 25
    #: Called with the records of a round that passed the judge.
    store: Callable[[DataFrame], None] | None = None
    extra: dict = field(default_factory=dict)


@dataclass
class Stage:
    name: str
    apply: Callable[[DataFrame, dict[str, DataFrame], Context], DataFrame]
    by_chunk: bool = True


def _asked(system: str, read: Callable[[Column], dict[str, Column]]) -> Callable[[DataFrame, dict[str, DataFrame], Context], DataFrame]:
    """One call for each chunk; ``read`` makes the columns of the answer."""

    def apply(chunks: DataFrame, prior: dict[str, DataFrame], ctx: Context) -> DataFrame:
        got = judges.completed(chunks, system, judges.extraction_prompt(F.col("text")), ctx.connect)
        fine = F.col("answer_error").isNull()
        columns = [F.when(fine, c).alias(n) for n, c in read(F.col("answer")).items()]
        return got.select("chunk_id", *columns, F.col("answer_error").alias("error"), F.col("answer_tokens").alias("tokens"))

    return apply


def merge_types(chunks: DataFrame, prior: dict[str, DataFrame], ctx: Context) -> DataFrame:
    """(term, canonical): one call over the sorted vocabulary of types, a bounded list of names. An answer that can't be read, and
    a term that the answer leaves out, stand for themselves."""
    spark = chunks.sparkSession
    terms = [r["term"] for r in passes.vocabulary(prior["types"].filter("object_types IS NOT NULL"), "object_types").collect()]
    asked = spark.createDataFrame([(json.dumps(terms),)], "prompt string")
    got = judges.completed(asked, judges.MERGE_SYSTEM, F.concat(F.lit("Types:\n"), "prompt"), ctx.connect)
    mapping = F.try_variant_get(jsonx.json_object("answer"), "$.mapping", "map<string,string>")
    pairs = got.select(F.explode(mapping).alias("raw", "canonical"))
    return passes.consolidate(spark.createDataFrame([(t,) for t in terms], "term string"), pairs)


def fill_values(chunks: DataFrame, prior: dict[str, DataFrame], ctx: Context) -> DataFrame:
    """One record for each chunk, tried until the judge accepts it or the model's own confidence levels off.

    A round is one table over the chunks still open: propose, test for the plateau, locate, cut, judge. What the judge
    said goes into the next round's prompt but does not decide whether there is one. Rows: chunk_id, grounded, attempts,
    trajectory of confidences, best_confidence, the record's columns and the last reason."""
    if ctx.judge is None:
        raise ValueError("fill_values needs a judge")
    types = F.lit(None).cast("array<string>")
    if "merged" in prior:
        names = [r[0] for r in prior["merged"].select("canonical").distinct().orderBy("canonical").collect()]  # a bounded list of names
        types = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    open_ = chunks.select("chunk_id", F.col("text").alias("source_text"), F.lit(None).cast("string").alias("feedback"), F.lit(0.0).alias("best"), F.array().cast("array<double>").alias("trajectory"), F.lit(None).cast("string").alias("last_reason"))
    done: list[DataFrame] = []
    keep = ["chunk_id", "grounded", "attempts", "trajectory", "best_confidence", "quote", "record_type", "tier", "fields", "actor", "event_date", "confidence", "char_start", "char_end", "evidence_span", "verdict", "failing_values", "judge_reason", "flagged", "reason_code", "detail", "error", "tokens"]

    def closed(df: DataFrame, ok: Column) -> DataFrame:
        have = {c: F.col(c) for c in df.columns}
        kinds = {"failing_values": "array<string>", "char_start": "int", "char_end": "int", "flagged": "boolean", "confidence": "double"}
        out = have | {"grounded": ok, "attempts": F.size("trajectory"), "best_confidence": F.col("best")}
        return df.select(*[out.get(c, F.lit(None).cast(kinds.get(c, "string"))).alias(c) for c in keep])

    for _ in range(ctx.cap):
        got = judges.completed(open_, judges.FILL_SYSTEM, judges.fill_prompt(types, F.col("source_text"), F.col("feedback")), ctx.connect)
        v = jsonx.json_object("answer")
        text = lambda k: F.nullif(F.try_variant_get(v, f"$.{k}", "string"), F.lit(""))  # noqa: B023, E731
        fill = jsonx.fill("answer")
        tier = text("tier")
        got = got.select(
            *open_.columns, fill["quote"].alias("quote"), fill["confidence"].alias("confidence"), F.coalesce(F.trim(text("record_type")), F.lit("fact")).alias("record_type"), F.when(tier.isin(*grounding.TIERS), tier).otherwise("fact").alias("tier"),
            F.coalesce(F.when(jsonx.kind(F.try_variant_get(v, "$.fields", "variant")) == "object", F.to_json(F.try_variant_get(v, "$.fields", "variant"))), F.lit("{}")).alias("fields"), text("actor").alias("actor"), text("event_date").alias("event_date"),
            F.col("answer_error").alias("error"), F.col("answer_tokens").alias("tokens"),
        )
        first = F.size("trajectory") == 0
        got = got.withColumn("level", ~first & (F.col("confidence") < F.col("best") + ctx.eps))
        got = got.withColumns({"trajectory": F.when(F.col("error").isNull(), F.concat("trajectory", F.array("confidence"))).otherwise(F.col("trajectory")), "best": F.when(F.col("error").isNull(), F.greatest("best", "confidence")).otherwise(F.col("best"))})
        got = durable(got)  # asked once, though it branches
        done.append(closed(got.filter("error IS NOT NULL OR level").withColumn("reason_code", F.col("last_reason")), F.lit(False)))
        tried = grounding.begin(got.filter("error IS NULL AND NOT level"))
        tried = grounding.cut(grounding.locate(tried))
        tried = tried.withColumn("claim", grounding.claim(F.col("actor"), F.col("event_date"), F.col("fields"), F.lit(None).cast("string"), F.col("tier"), F.col("record_type")))
        tried = durable(grounding.gate(grounding.judged(tried, ctx.judge)))
        passed = tried.filter("ok")
        done.append(closed(passed, F.lit(True)))
        if ctx.store:
            ctx.store(passed)
        said = F.when(F.col("reason_code") == "locate_miss", F.lit("the quote is not in the passage; copy it anew")).otherwise(F.concat_ws(" ", "reason_code", F.nullif(F.col("detail"), F.lit(""))))
        open_ = tried.filter("NOT ok").select("chunk_id", "source_text", said.alias("feedback"), "best", "trajectory", F.col("reason_code").alias("last_reason"))
        if not open_.limit(1).count():
            break
    done.append(closed(open_.withColumn("reason_code", F.col("last_reason")), F.lit(False)))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def cleaned(chunks: DataFrame, prior: dict[str, DataFrame], ctx: Context) -> DataFrame:
    return passes.clean_chunks(prior["keywords"].select("chunk_id", "keywords"))


STAGES = [
    Stage("prose", _asked(judges.PROSE_SYSTEM, lambda a: {"label": parse_prose_label(a)})),
    Stage("types", _asked(judges.TYPES_SYSTEM, lambda a: {"object_types": jsonx.type_list(a)})),
    Stage("merged", merge_types, by_chunk=False),
    Stage("fill", fill_values),
    Stage("keywords", _asked(judges.KEYWORDS_SYSTEM, lambda a: {"keywords": jsonx.keyword_list(a)})),
    Stage("cleaned", cleaned, by_chunk=False),
    Stage("meaning", _asked(judges.MEANING_SYSTEM, lambda a: {"claim_meaning": jsonx.meaning(a)["claim_meaning"], "questions_answered": jsonx.meaning(a)["questions"]})),
]


def percent(stage: int, stages: int, chunk: int, chunks: int) -> float:
    """Share of all work that is done: ``stage`` whole stages before this one and ``chunk`` chunks of it."""
    return 100.0 * (stage * chunks + chunk) / (stages * chunks) if stages and chunks else 0.0


def remaining_s(elapsed_s: float, done: int, total: int) -> float:
    """Seconds left at the pace so far."""
    return elapsed_s / done * (total - done) if done else 0.0


def run_stages(chunks: DataFrame, ctx: Context, out: str, stages: list[Stage] | None = None, emit: Callable[[str], None] = print) -> dict[str, DataFrame]:
    """Tables of every stage by name, also written under ``out``; a stage that fails as a whole becomes a table with an
    error, and the run goes on. ``chunks``: chunk_id, text."""
    spark, stages = chunks.sparkSession, STAGES if stages is None else stages
    chunks.write.mode("errorifexists").parquet(f"{out}/inputs")
    chunks = spark.read.parquet(f"{out}/inputs")
    n, results, begun = chunks.count(), {}, time.monotonic()
    for i, stage in enumerate(stages):
        at = time.monotonic()
        try:
            stage.apply(chunks, results, ctx).write.mode("errorifexists").parquet(f"{out}/{stage.name}")
            results[stage.name] = spark.read.parquet(f"{out}/{stage.name}")
        except Exception as e:  # contained: later stages that need it fail likewise
            results[stage.name] = spark.createDataFrame([(f"{type(e).__name__}: {e}"[:500],)], "error string")
            emit(f"{stage.name} failed: {type(e).__name__}")
        tokens = results[stage.name].agg(F.sum("tokens")).head()[0] if "tokens" in results[stage.name].columns else 0
        took, elapsed = max(time.monotonic() - at, 1e-9), time.monotonic() - begun
        emit(f"stage {i + 1}/{len(stages)} {stage.name} | {n} chunks | {(tokens or 0) / took:.1f} tokens/s | {percent(i, len(stages), n, n):.0f}% | {remaining_s(elapsed, i + 1, len(stages)):.0f} s left")
    return results


def faithful(fill: DataFrame) -> DataFrame:
    """Outcome by chunk as the gate reads it; totals by scoring.faithfulness."""
    return fill.select("chunk_id", F.coalesce("grounded", F.lit(False)).alias("grounded"), "reason_code", "attempts", "best_confidence")


def canonical_types(types: DataFrame, merged: DataFrame) -> DataFrame:
    """Canonical types of each chunk."""
    e = types.select("chunk_id", F.explode("object_types").alias("term")).join(merged, "term", "left")
    return e.groupBy("chunk_id").agg(F.array_sort(F.collect_set(F.coalesce(normalize_type("canonical"), "term"))).alias("types"))
