"""Column functions on the JSON that models answer with: lenient where the text around it is noise, closed where
a verdict is missing. All on VARIANT, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundmill.functions.text import clean_keyword, none_if_blank, normalize_keyword, normalize_type, strip

VERDICTS = ("grounded", "partial", "ungrounded")


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def kind(v: Column) -> Column:
    """Coarse type of a VARIANT: object, array, string, number, boolean, null."""
    s = F.schema_of_variant(v)
    return (
        F.when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array").when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s == "VOID", "null").when(v.isNotNull(), "number")
    )


def _lenient(raw: Column | str, greedy: str) -> Column:
    """The whole text as JSON; only where that fails, the widest bracketed part of it."""
    raw = _col(raw)
    whole = F.try_parse_json(raw)
    return F.when(whole.isNotNull(), whole).otherwise(F.try_parse_json(F.nullif(F.regexp_extract(raw, greedy, 0), F.lit(""))))


def json_array(raw: Column | str) -> Column:
    """ARRAY<VARIANT>; empty for anything that is no list."""
    v = _lenient(raw, r"(?s)\[.*\]")
    return F.coalesce(F.when(kind(v) == "array", F.try_variant_get(v, "$", "array<variant>")), F.array().cast("array<variant>"))


def json_object(raw: Column | str) -> Column:
    """VARIANT object or null."""
    v = _lenient(raw, r"(?s)\{.*\}")
    return F.when(kind(v) == "object", v)


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def judge_answer(raw: Column | str) -> Column:
    """STRUCT<verdict, failing_values, reason>; verdict null where the answer can't be relied on."""
    v = json_object(raw)
    verdict = F.lower(strip(_text(v, "$.verdict")))
    failing = F.try_variant_get(v, "$.failing_values", "variant")
    values = F.when(kind(failing) == "array", F.coalesce(F.try_variant_get(failing, "$", "array<string>"), F.array().cast("array<string>"))).when(kind(failing).isin("string", "number"), F.filter(F.array(F.try_variant_get(failing, "$", "string")), lambda x: (x != "") & (x != "0")))
    return F.struct(
        F.when(verdict.isin(*VERDICTS), verdict).alias("verdict"), F.coalesce(values, F.array().cast("array<string>")).alias("failing_values"), F.coalesce(_text(v, "$.reason"), F.lit("")).alias("reason"), _col(raw).alias("raw")
    )


def wrapped_array(raw: Column | str) -> Column:
    """ARRAY<VARIANT> of a list, or of the first list under records, facts, proposals or items of an object;
    any other object is a list of one."""
    raw = _col(raw)
    whole = F.try_parse_json(raw)
    v = F.when(whole.isNotNull(), whole).otherwise(F.try_parse_json(F.nullif(F.regexp_extract(raw, r"(?s)\[.*\]", 0), F.lit(""))))
    inner = [F.when(kind(F.try_variant_get(v, f"$.{k}", "variant")) == "array", F.try_variant_get(v, f"$.{k}", "array<variant>")) for k in ("records", "facts", "proposals", "items")]
    empty = F.array().cast("array<variant>")
    return F.coalesce(F.when(kind(v) == "array", F.try_variant_get(v, "$", "array<variant>")).when(kind(v) == "object", F.coalesce(*inner, F.array(v))), empty)


def proposals(raw: Column | str) -> Column:
    """ARRAY<STRUCT> of the usable proposals of an answer."""
    number = lambda v: F.when(kind(F.try_variant_get(v, "$.confidence", "variant")) == "number", F.try_variant_get(v, "$.confidence", "double"))
    string = lambda v, k: F.when(kind(F.try_variant_get(v, f"$.{k}", "variant")) == "string", _text(v, f"$.{k}"))
    usable = lambda v: (kind(v) == "object") & (F.length(strip(F.coalesce(string(v, "quote"), F.lit("")))) > 0)
    return F.transform(
        F.filter(wrapped_array(raw), usable),
        lambda v: F.struct(
            string(v, "quote").alias("quote"), F.coalesce(F.nullif(strip(string(v, "record_type")), F.lit("")), F.lit("fact")).alias("record_type"), F.coalesce(F.nullif(_text(v, "$.tier"), F.lit("")), F.lit("fact")).alias("tier"),
            F.coalesce(F.when(kind(F.try_variant_get(v, "$.fields", "variant")) == "object", F.to_json(F.try_variant_get(v, "$.fields", "variant"))), F.lit("{}")).alias("fields"),
            none_if_blank(string(v, "actor")).alias("actor"), none_if_blank(string(v, "event_date")).alias("event_date"), none_if_blank(string(v, "claim_relevance")).alias("claim_relevance"), number(v).alias("confidence"),
        ),
    )


def type_list(raw: Column | str) -> Column:
    names = F.transform(json_array(raw), lambda v: F.when(kind(v) == "string", F.try_variant_get(v, "$", "string")).when(kind(v) == "object", _text(v, "$.name")))
    return F.array_distinct(F.filter(F.transform(names, lambda x: normalize_type(x)), lambda x: x.isNotNull() & (x != "")))


def keyword_list(raw: Column | str) -> Column:
    words = F.transform(json_array(raw), lambda v: F.when(kind(v) == "string", F.try_variant_get(v, "$", "string")))
    return F.array_distinct(F.filter(F.transform(words, lambda x: normalize_keyword(x)), lambda x: x.isNotNull() & (x != "")))


def cleaned_keywords(words: Column | str) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(_col(words), lambda w: clean_keyword(w)), lambda x: x != "")))


def meaning(raw: Column | str) -> Column:
    """STRUCT<claim_meaning, questions>: of the object, else the bare text."""
    v = json_object(raw)
    own = F.when(kind(F.try_variant_get(v, "$.claim_meaning", "variant")) == "string", F.nullif(strip(_text(v, "$.claim_meaning")), F.lit("")))
    asked = F.when(kind(F.try_variant_get(v, "$.questions_answered", "variant")) == "array", F.try_variant_get(v, "$.questions_answered", "array<string>"))
    empty = F.array().cast("array<string>")
    return F.struct(F.coalesce(own, strip(raw)).alias("claim_meaning"), F.when(own.isNotNull(), F.coalesce(asked, empty)).otherwise(empty).alias("questions"))


def fill(raw: Column | str) -> Column:
    """STRUCT<quote, confidence>: of the object; nothing found is an empty quote of confidence 0, as is NaN."""
    v = json_object(raw)
    c = F.coalesce(F.try_variant_get(v, "$.confidence", "double"), F.lit(0.0))
    return F.struct(F.coalesce(_text(v, "$.quote"), F.lit("")).alias("quote"), F.when(F.isnan(c), 0.0).otherwise(c).alias("confidence"))
