"""Links between records: validation, both ends, both spans, four hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundmill.common import norm_id
from groundmill.functions.jsonx import kind
from groundmill.functions.text import normalize_type, sha256_text, strip
from groundmill.operators.grounding import TIERS, fail

# Relations known in advance; any other is accepted too.
SEED_RELATIONS = ("precedes", "follows", "causes", "results_from", "corroborates", "contradicts", "elaborates", "same_event", "references")


def first_problem(p: Column) -> Column:
    """First thing wrong with a link payload (VARIANT), or null."""
    get = lambda path: F.try_variant_get(p, path, "variant")
    text = lambda k: F.when(kind(get(f"$.{k}")) == "string", F.try_variant_get(p, f"$.{k}", "string"))
    blank = lambda k: F.length(strip(F.coalesce(text(k), F.lit("")))) == 0

    def span(k: str) -> Column:
        pair = F.try_variant_get(p, f"$.evidence.{k}", "array<variant>")
        whole = lambda v: F.coalesce(F.schema_of_variant(v).isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit(False))
        return F.coalesce((kind(get(f"$.evidence.{k}")) == "array") & (F.size(pair) == 2) & F.forall(pair, whole), F.lit(False))

    number = F.try_variant_get(p, "$.confidence", "double")
    there = F.coalesce(kind(get("$.confidence")), F.lit("null")) != "null"
    checks = [
        (~F.coalesce(kind(p) == "object", F.lit(False)), "payload must be an object"),
        *[(blank(k), f"{k} must be text") for k in ("record_a", "record_b", "relation", "rationale")],
        (text("record_a") == text("record_b"), "a link joins two records"),
        (~F.coalesce(text("tier").isin(*TIERS), F.lit(False)), "tier must be fact or interpretation"),
        (~F.coalesce(kind(get("$.evidence")) == "object", F.lit(False)), "evidence must be an object"),
        *[(~span(k), f"{k} must be two whole numbers") for k in ("a_span", "b_span")],
        (there & ~F.coalesce((kind(get("$.confidence")) == "number") & number.between(0, 1), F.lit(False)), "confidence must be a number from 0 to 1"),
    ]
    return F.coalesce(*[F.when(bad, F.lit(what)) for bad, what in checks])


def is_seed(relation: Column) -> Column:
    """Whether a relation is of the vocabulary known in advance, spelled loosely."""
    return F.coalesce(normalize_type(relation).isin(*SEED_RELATIONS), F.lit(False))


def validate(df: DataFrame, payload: str = "payload") -> DataFrame:
    df = df.withColumn("_problem", first_problem(F.try_parse_json(F.col(payload))))
    return fail(df, F.col("_problem").isNotNull(), "schema_invalid", F.col("_problem")).drop("_problem")


def with_ends(links: DataFrame, records: DataFrame, frags: DataFrame) -> DataFrame:
    """Both records and both texts; a missing record a is named before a missing record b."""
    for side in "ab":
        r = records.select(norm_id("record_id").alias(f"_{side}"), norm_id("source_chunk_id").alias(f"{side}_chunk")).dropDuplicates([f"_{side}"])
        links = links.join(r, norm_id(f"record_{side}") == F.col(f"_{side}"), "left")
    for side in "ab":
        links = fail(links, F.col(f"_{side}").isNull(), "unknown_record", F.concat(F.lit(f"record_{side} "), f"record_{side}"))
    for side in "ab":
        f = frags.select(F.col("chunk_id").alias(f"_f{side}"), F.col("text").alias(f"{side}_text"))
        links = links.join(f, F.col(f"{side}_chunk") == F.col(f"_f{side}"), "left")
        links = fail(links, F.col(f"_f{side}").isNull(), "fragment_not_found", F.concat(F.lit(f"record_{side} "), f"record_{side}"))
    return links.drop("_a", "_b", "_fa", "_fb")


def with_spans(links: DataFrame, evidence: str = "evidence") -> DataFrame:
    e = F.from_json(evidence, "a_span array<int>, b_span array<int>")
    links = links.withColumn("_e", e)
    for side in "ab":
        s, t = F.get(F.col(f"_e.{side}_span"), F.lit(0)), F.get(F.col(f"_e.{side}_span"), F.lit(1))
        links = fail(links, ~F.coalesce((s >= 0) & (s < t) & (t <= F.length(f"{side}_text")), F.lit(False)), "bad_offsets", f"{side}_span")
        links = links.withColumn(f"{side}_evidence", F.when(F.col("reason_code").isNull(), F.substring(F.col(f"{side}_text"), s + 1, t - s)))
    for side in "ab":
        links = fail(links, ~F.col(f"{side}_evidence").rlike(r"(?U)[^\s\x{1c}-\x{1f}]"), "empty_span", f"{side}_span")
    return links.drop("_e")


def hashes(links: DataFrame) -> DataFrame:
    return links.withColumns({f"{side}_{what}_sha256": F.when(F.col("reason_code").isNull(), sha256_text(f"{side}_{col}")) for side in "ab" for what, col in (("evidence", "evidence"), ("source", "text"))})


LINK = ["link_id", "record_a", "record_b", "relation", "tier", "evidence", "confidence", "provenance_validation", "event_entity", "flagged", "created"]


def attest(links: DataFrame, judge_model: str, judge_version: str, at: str) -> DataFrame:
    """provenance_validation with all four hashes, and evidence with the spans and the fragments they were cut from."""
    e = F.from_json("evidence", "a_span array<int>, b_span array<int>")
    whole = F.to_json(F.struct(e["a_span"].alias("a_span"), e["b_span"].alias("b_span"), F.col("a_chunk").alias("a_source_chunk_id"), F.col("b_chunk").alias("b_source_chunk_id")))
    hashes_ = [F.col(f"{side}_{what}_sha256") for what in ("evidence", "source") for side in "ab"]
    failing = F.when(F.size("failing_values") > 0, F.col("failing_values"))
    stamp = F.struct(F.col("verdict"), F.lit(judge_model).alias("judge_model"), F.lit(judge_version).alias("judge_version"), F.lit(at).alias("validated_at"), *hashes_, failing.alias("failing_values"))
    return links.withColumns({"evidence": F.when(F.col("ok"), whole), "provenance_validation": F.when(F.col("ok"), stamp)})


def symmetric(links: DataFrame) -> DataFrame:
    """Direction taken out, for counting."""
    a, b = norm_id("record_a"), norm_id("record_b")
    return links.withColumns({"first": F.least(a, b), "second": F.greatest(a, b)})
