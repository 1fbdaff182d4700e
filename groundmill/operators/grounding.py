"""Grounding: from a proposal to an attested record, as stages over DataFrames.

A stage adds columns and sets ``reason_code`` at the first failure; rows with a reason pass the later stages
untouched. The costly judge sees survivors only: they are split off by a filter and its answers are
written before anything branches, so a row is judged once whatever is made of the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundmill.common import durable, norm_id
from groundmill.functions.jsonx import kind
from groundmill.functions.text import any_id, locate_quote, normalize_actor, sha256_text, strip

TIERS = ("fact", "interpretation")
# Columns that only code may set, so a payload that carries one is refused.
CODE_OWNED = ("evidence_span", "page", "document", "provenance_validation", "source_sha256", "evidence_sha256", "source_chunk_id")


def fail(df: DataFrame, bad: Column, code: str, detail: Column | str = "") -> DataFrame:
    """Sets the reason of rows that have none yet."""
    d = F.lit(detail) if isinstance(detail, str) else detail
    # each column refers to itself once: a longer cascade would else double the plan at every stage
    return df.withColumns({"reason_code": F.coalesce("reason_code", F.when(bad, F.lit(code))), "detail": F.coalesce("detail", F.when(bad, F.coalesce(d, F.lit(""))))})


def begin(df: DataFrame) -> DataFrame:
    return df.withColumns({"reason_code": F.lit(None).cast("string"), "detail": F.lit(None).cast("string")})


def first_problem(payload: Column) -> Column:
    """First thing wrong with a record payload (VARIANT), or null."""
    get = lambda k: F.try_variant_get(payload, f"$.{k}", "variant")
    of = lambda k: kind(get(k))
    text = lambda k: F.when(of(k) == "string", F.try_variant_get(payload, f"$.{k}", "string"))
    whole = lambda k: (of(k) == "number") & F.schema_of_variant(get(k)).isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    present = lambda k: F.coalesce(of(k), F.lit("null")) != "null"
    number = F.try_variant_get(payload, "$.confidence", "double")
    checks = [
        (~F.coalesce(kind(payload) == "object", F.lit(False)), "payload must be an object"),
        *[(get(k).isNotNull(), f"{k} is set by code") for k in CODE_OWNED],
        (F.length(strip(F.coalesce(text("record_type"), F.lit("")))) == 0, "record_type must be text"),
        (~F.coalesce(text("tier").isin(*TIERS), F.lit(False)), "tier must be fact or interpretation"),
        *[(~F.coalesce(whole(k), F.lit(False)), f"{k} must be a whole number") for k in ("char_start", "char_end")],
        (get("fields").isNotNull() & (of("fields") != "object"), "fields must be an object"),
        (present("confidence") & ~F.coalesce((of("confidence") == "number") & number.between(0, 1), F.lit(False)), "confidence must be a number from 0 to 1"),
        *[(present(k) & (of(k) != "string"), f"{k} must be text") for k in ("actor", "event_date", "claim_relevance", "chunk_id", "chunk_handle")],
    ]
    return F.coalesce(*[F.when(bad, F.lit(what)) for bad, what in checks])


def validate(df: DataFrame, payload: str = "payload") -> DataFrame:
    problem = first_problem(F.try_parse_json(F.col(payload)))
    return fail(df.withColumn("_problem", problem), F.col("_problem").isNotNull(), "schema_invalid", F.col("_problem")).drop("_problem")


def resolve(df: DataFrame, handles: DataFrame) -> DataFrame:
    """``resolved_id``: a handle wins; else the id given; else the workstream's current fragment. A handle that is
    unknown, or that names another fragment than the id, is unknown_fragment. ``df``: workstream, chunk_handle,
    chunk_id, current_id; ``handles``: workstream, handle, chunk_id."""
    h = handles.select(F.col("workstream").alias("_w"), F.col("handle").alias("_h"), norm_id("chunk_id").alias("_of"))
    j = df.join(h, (F.col("workstream") == F.col("_w")) & (F.col("chunk_handle") == F.col("_h")), "left")
    j = j.withColumn("resolved_id", F.when(F.col("chunk_handle").isNotNull(), F.col("_of")).otherwise(F.coalesce(any_id("chunk_id"), any_id("current_id"))))
    j = fail(j, F.col("chunk_handle").isNotNull() & F.col("_of").isNull(), "unknown_fragment", "handle not minted")
    j = fail(j, F.col("chunk_handle").isNotNull() & F.col("chunk_id").isNotNull() & (F.col("_of") != any_id("chunk_id")), "unknown_fragment", "handle and id disagree")
    return fail(j, F.col("resolved_id").isNull(), "unknown_fragment", "nothing to resolve").drop("_w", "_h", "_of")


def load(df: DataFrame, frags: DataFrame, key: str = "resolved_id") -> DataFrame:
    f = frags.select(F.col("chunk_id").alias("_f"), F.col("text").alias("source_text"), F.col("document").alias("source_document"), F.col("page").alias("source_page"))
    return fail(df.join(f, F.col(key) == F.col("_f"), "left"), F.col("_f").isNull(), "fragment_not_found").drop("_f")


def locate(df: DataFrame, quote: str = "quote", text: str = "source_text") -> DataFrame:
    """char_start and char_end of the quote; locate_miss where the text has none."""
    j = df.withColumn("_at", locate_quote(text, quote))
    j = j.withColumns({"char_start": F.col("_at.start"), "char_end": F.col("_at.end")})
    return fail(j, F.col("_at").isNull(), "locate_miss").drop("_at")


def cut(df: DataFrame, text: str = "source_text", start: str = "char_start", end: str = "char_end", into: str = "evidence_span") -> DataFrame:
    """The span as code copies it; offsets are code points."""
    s, e = F.col(start), F.col(end)
    df = fail(df, ~F.coalesce((s >= 0) & (s < e) & (e <= F.length(text)), F.lit(False)), "bad_offsets")
    df = df.withColumn(into, F.when(F.col("reason_code").isNull(), F.substring(F.col(text), s + 1, e - s)))
    return fail(df, ~F.col(into).rlike(r"(?U)[^\s\x{1c}-\x{1f}]"), "empty_span")


def sorted_json(fields: Column) -> Column:
    """A flat JSON object with its keys in order, ", " and ": " between; deeper values keep their own text."""
    pairs = F.from_json(fields, "map<string,string>")
    one = lambda k: F.concat(F.lit('"'), k, F.lit('": '), _json_value(k, pairs))
    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_keys(pairs)), one), ", "), F.lit("}"))


def _json_value(k: Column, pairs: Column) -> Column:
    text = F.element_at(pairs, k)
    plain = text.rlike(r"^(?:-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|\[.*\]|\{.*\})$")
    quoted = F.concat(F.lit('"'), F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.when(text.isNull(), F.lit("null")).when(plain, text).otherwise(quoted)


def claim(actor: Column, date: Column, fields: Column, relevance: Column, tier: Column, record_type: Column) -> Column:
    """What the judge is asked to hold against the span; the type is named only where nothing else is."""
    filled = lambda c: F.when(F.length(c) > 0, c)
    parts = F.concat_ws(
        "; ",
        F.concat(F.lit("actor: "), filled(actor)), F.concat(F.lit("event_date: "), filled(date)),
        F.concat(F.lit("details: "), F.when(~F.coalesce(fields, F.lit("{}")).rlike(r"^\s*\{\s*\}\s*$"), sorted_json(fields))),
        F.concat(F.lit("relevance: "), F.when(tier == "interpretation", filled(relevance))),
    )
    return F.when(parts != "", parts).otherwise(F.concat(F.lit("the span records a "), record_type, F.lit(" event")))


def judged(df: DataFrame, judge) -> DataFrame:
    """Rows without a reason get ``verdict``, ``failing_values`` and ``judge_reason`` of ``judge``, a function from
    DataFrame to DataFrame; written once (see the module's head)."""
    df = durable(df)  # else the filter below would repeat every stage before it for either branch
    alive = durable(judge(df.filter("reason_code IS NULL")))
    rest = df.filter("reason_code IS NOT NULL")
    for c, t in (("verdict", "string"), ("failing_values", "array<string>"), ("judge_reason", "string")):
        rest = rest.withColumn(c, F.lit(None).cast(t))
    return fail(alive, F.col("verdict").isNull(), "judge_unavailable").unionByName(rest)


def gate(df: DataFrame, fact_reason: str = "ungrounded_fact", interpretation_reason: str = "unsupported_interpretation") -> DataFrame:
    """grounded passes; partial passes flagged as an interpretation and fails as a fact; ungrounded fails."""
    v, fact = F.col("verdict"), F.col("tier") == "fact"
    more = [F.when(F.size("failing_values") > 0, F.concat(F.lit("failing_values="), F.to_json("failing_values")))] if "failing_values" in df.columns else []
    more += [F.nullif(F.col("judge_reason"), F.lit(""))] if "judge_reason" in df.columns else []
    why = F.concat_ws(" ", F.concat(F.lit("judge="), v), *more)
    df = fail(df, fact & v.isin("partial", "ungrounded"), fact_reason, why)
    df = fail(df, ~fact & (v == "ungrounded"), interpretation_reason, why)
    return df.withColumns({"ok": F.col("reason_code").isNull(), "flagged": F.col("reason_code").isNull() & (v == "partial")})


def without_text(df: DataFrame) -> DataFrame:
    """The hash of the source in place of its text, so that what is written before the judge carries no texts but the span."""
    return df.withColumn("source_hash", sha256_text("source_text")).drop("source_text", "quote", "fid")


def attest(df: DataFrame, judge_model: str, judge_version: str, at: str, text: str = "source_text", span: str = "evidence_span") -> DataFrame:
    """provenance_validation: verdict, judge, time of the run and hashes of span and source."""
    source = F.col("source_hash") if "source_hash" in df.columns else sha256_text(text)
    failing = F.when(F.size("failing_values") > 0, F.col("failing_values"))
    return df.withColumn("provenance_validation", F.when(F.col("ok"), F.struct(
        F.col("verdict"), F.lit(judge_model).alias("judge_model"), F.lit(judge_version).alias("judge_version"), F.lit(at).alias("validated_at"), sha256_text(span).alias("evidence_sha256"), source.alias("source_sha256"), failing.alias("failing_values"),
    )))


def tampered(records: DataFrame, frags: DataFrame) -> DataFrame:
    """Stored records whose source or span no longer has the attested hash."""
    f = frags.select(F.col("chunk_id").alias("_f"), "text")
    j = records.join(f, norm_id("source_chunk_id") == F.col("_f"), "left")
    return j.select(
        norm_id("record_id").alias("record_id"), F.col("_f").isNull().alias("source_missing"),
        F.coalesce(sha256_text("text") != F.col("provenance_validation.source_sha256"), F.lit(False)).alias("source_changed"),
        (sha256_text("evidence_span") != F.col("provenance_validation.evidence_sha256")).alias("span_changed"),
        F.coalesce(F.substring(F.col("text"), F.col("char_start") + 1, F.col("char_end") - F.col("char_start")) != F.col("evidence_span"), F.lit(False)).alias("span_moved"),
    )


def entity_refs(actor: Column, actor_id: Column, date: Column, date_id: Column) -> Column:
    """The actor's reference, then the date's, of each that is not empty as given."""
    ref = lambda role, kind_, id_, given, c: F.when(F.length(given) > 0, F.struct(F.lit(role).alias("role"), id_.alias("entity_id"), F.lit(kind_).alias("entity_type"), c.alias("canonical")))
    return F.array_compact(F.array(ref("actor", "actor", actor_id, actor, normalize_actor(actor)), ref("event_date", "date", date_id, date, strip(date))))
