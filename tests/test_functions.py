import json

import pytest
from pyspark.sql import functions as F

from groundmill.functions import jsonx, text
from groundmill.operators import grounding, judges, links


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).head()["r"]


@pytest.mark.parametrize(("doc", "quote", "span"), [
    ("Supervisor B. Smith reversed it", "B. Smith reversed", (11, 28)),
    ("Supervisor B. Smith    reversed it", "B. Smith reversed", (11, 31)),
    ("Supervisor B. Smith reversed it", "B. Smith APPROVED", None),
    ("x\U0001F600 a \t b", "a b", (3, 8)),
    ("twice twice", "twice", (0, 5)),
    ("a.b axb", "axb", (4, 7)),
    (r"odd \E [x] (y)", r"\E  [x]", (4, 10)),
    ("abc", "  ", None),
    ("", "a", None),
    (None, "a", None),
    ("abc", None, None),
    ("w " * 20000 + "end", "w end", (39998, 40003)),
])
def test_locate(spark, doc, quote, span):
    r = spark.createDataFrame([(doc, quote)], "t string, q string").select(text.locate_quote("t", "q").alias("r")).head()["r"]
    assert (r and tuple(r)) == span


@pytest.mark.parametrize(("f", "value", "want"), [
    (text.normalize_actor, " B.  Smith \n", "B. Smith"),
    (text.normalize_date, "\t2025-02-18 ", "2025-02-18"),
    (text.normalize_type, " Status Change! ", "status_change"),
    (text.normalize_type, "café", "caf"),
    (text.normalize_keyword, " Long  COVID ", "long covid"),
    (text.clean_keyword, "THE", ""),
    (text.clean_keyword, "x", ""),
    (text.clean_keyword, " Long  COVID ", "long covid"),
    (text.parse_prose_label, "Non-prose.", "non_prose"),
    (text.parse_prose_label, " Prose", "prose"),
    (text.parse_prose_label, "neither", "non_prose"),
    (text.none_if_blank, " NULL ", None),
    (text.none_if_blank, " x ", " x "),
    (text.identifier, "Qwen-3.5 x", "qwen_3_5_x"),
    (text.sha256_text, "abc", "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"),
])
def test_text(spark, f, value, want):
    assert one(spark, value, f) == want
    assert one(spark, None, f) in (None, "non_prose")


@pytest.mark.parametrize(("value", "want"), [("89503c71-5ca2-424b-9386-6698a8337dc3", True), ("{89503C715CA2424B93866698A8337DC3}", True), ("urn:uuid:89503c71-5ca2-424b-9386-6698a8337dc3", True), ("F7", False), (None, False)])
def test_uuid(spark, value, want):
    assert one(spark, value, text.is_uuid) is want


def test_page_range(spark):
    assert tuple(one(spark, "d/file_410-412.pdf", text.page_range)) == ("file_410-412", 410, 412)
    assert one(spark, "none.pdf", text.page_range)["lo"] is None


@pytest.mark.parametrize(("raw", "n"), [('["a": "b"]', 0), ("noise [not, valid, json,] tail", 0), ('x ["a", 1] y', 2), ('{"a": 1}', 0), (None, 0), ("", 0)])
def test_json_array(spark, raw, n):
    assert one(spark, raw, lambda c: F.size(jsonx.json_array(c))) == n


@pytest.mark.parametrize(("raw", "verdict", "failing"), [
    ('{"verdict": " Grounded "}', "grounded", []),
    ('text {"verdict": "partial", "failing_values": "x"} more', "partial", ["x"]),
    ('{"verdict": "ungrounded", "failing_values": ["a", 2]}', "ungrounded", ["a", "2"]),
    ('{"verdict": "sure"}', None, []),
    ("{} {}", None, []),
    ("no json", None, []),
    (None, None, []),
])
def test_judge_answer_fails_closed(spark, raw, verdict, failing):
    r = one(spark, raw, jsonx.judge_answer)
    assert (r["verdict"], r["failing_values"]) == (verdict, failing)


def test_proposals(spark):
    raw = json.dumps({"facts": [{"quote": " q ", "actor": "null", "confidence": True, "fields": {"a": 1}}, {"quote": "  "}, 3, {"quote": "z", "record_type": " t ", "tier": "interpretation", "confidence": 0.5}]})
    a, b = one(spark, raw, jsonx.proposals)
    assert (a["quote"], a["record_type"], a["tier"], a["fields"], a["actor"], a["confidence"]) == (" q ", "fact", "fact", '{"a":1}', None, None)
    assert (b["record_type"], b["tier"], b["confidence"]) == ("t", "interpretation", 0.5)
    assert len(one(spark, '{"quote": "alone"}', jsonx.proposals)) == 1


def test_lists_meaning_and_fill(spark):
    assert one(spark, '["Status Change", "status_change", {"name": "date"}, 4]', jsonx.type_list) == ["status_change", "date"]
    assert one(spark, '["Long COVID", "long  covid", "B. Smith"]', jsonx.keyword_list) == ["long covid", "b. smith"]
    assert tuple(one(spark, '{"claim_meaning": " m ", "questions_answered": ["q", 1]}', jsonx.meaning)) == ("m", ["q", "1"])
    assert tuple(one(spark, " bare ", jsonx.meaning)) == ("bare", [])
    assert tuple(one(spark, '{"quote": "x", "confidence": "0.5"}', jsonx.fill)) == ("x", 0.5)
    assert tuple(one(spark, "nothing", jsonx.fill)) == ("", 0.0)


BASE = {"char_start": 0, "char_end": 28, "record_type": "status_change", "tier": "fact", "fields": {"change": "reversal"}, "actor": "B. Smith", "confidence": 0.9}


@pytest.mark.parametrize(("change", "problem"), [
    ({}, None), ({"evidence_span": "x"}, "evidence_span is set by code"), ({"record_type": " "}, "record_type must be text"), ({"tier": "guess"}, "tier must be fact or interpretation"), ({"tier": ["fact"]}, "tier must be fact or interpretation"),
    ({"char_start": "0"}, "char_start must be a whole number"), ({"char_start": True}, "char_start must be a whole number"), ({"char_end": 1.5}, "char_end must be a whole number"), ({"fields": []}, "fields must be an object"),
    ({"confidence": 1.5}, "confidence must be a number from 0 to 1"), ({"confidence": True}, "confidence must be a number from 0 to 1"), ({"confidence": None}, None), ({"actor": 3}, "actor must be text"), ({"tier": "x", "char_start": "0"}, "tier must be fact or interpretation"),
])
def test_record_payload(spark, change, problem):
    assert one(spark, json.dumps(BASE | change), lambda c: grounding.first_problem(F.try_parse_json(c))) == problem


def test_payload_that_is_no_object(spark):
    for raw in ("[1]", "junk", None):
        assert one(spark, raw, lambda c: grounding.first_problem(F.try_parse_json(c))) == "payload must be an object"


LINK = {"record_a": "a", "record_b": "b", "relation": "causes", "tier": "fact", "evidence": {"a_span": [0, 3], "b_span": [1, 2]}, "rationale": "r"}


@pytest.mark.parametrize(("change", "problem"), [
    ({}, None), ({"relation": ""}, "relation must be text"), ({"record_b": "a"}, "a link joins two records"), ({"evidence": 1}, "evidence must be an object"), ({"evidence": {"a_span": [0], "b_span": [0, 1]}}, "a_span must be two whole numbers"),
    ({"evidence": {"a_span": [0, 1], "b_span": [0, "1"]}}, "b_span must be two whole numbers"), ({"confidence": -1}, "confidence must be a number from 0 to 1"), ({"relation": "of_my_own"}, None),
])
def test_link_payload(spark, change, problem):
    assert one(spark, json.dumps(LINK | change), lambda c: links.first_problem(F.try_parse_json(c))) == problem


def test_claim(spark):
    row = spark.createDataFrame([("B. Smith", "", '{"b": "x\\"y", "a": 1}', "why", "interpretation", "t"), (None, None, "{}", "why", "fact", "t")], "a string, d string, f string, r string, t string, k string")
    got = [r[0] for r in row.select(grounding.claim(*[F.col(c) for c in "adfrtk"])).collect()]
    assert got == ['actor: B. Smith; details: {"a": 1, "b": "x\\"y"}; relevance: why', "the span records a t event"]


def test_gate_table(spark):
    rows = [("fact", "grounded"), ("fact", "partial"), ("fact", "ungrounded"), ("interpretation", "grounded"), ("interpretation", "partial"), ("interpretation", "ungrounded")]
    got = grounding.gate(grounding.begin(spark.createDataFrame(rows, "tier string, verdict string"))).collect()
    assert [(r["ok"], r["flagged"], r["reason_code"]) for r in got] == [(True, False, None), (False, False, "ungrounded_fact"), (False, False, "ungrounded_fact"), (True, False, None), (True, True, None), (False, False, "unsupported_interpretation")]


@pytest.mark.parametrize(("s", "e", "reason"), [(0, 3, None), (-1, 5, "bad_offsets"), (5, 5, "bad_offsets"), (10, 5, "bad_offsets"), (0, 99, "bad_offsets"), (3, 6, "empty_span"), (None, 3, "bad_offsets")])
def test_cut(spark, s, e, reason):
    df = grounding.begin(spark.createDataFrame([("abc   def", s, e)], "source_text string, char_start int, char_end int"))
    r = grounding.cut(df).head()
    assert (r["reason_code"], r["evidence_span"] if reason is None else None) == (reason, "abc" if reason is None else None)


def test_judge_sees_survivors_only_and_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def connect():
        def client(system, prompt):
            calls.add(1)
            return '{"verdict": "grounded"}', 3

        return client

    df = grounding.begin(spark.range(20)).withColumn("reason_code", F.when(F.col("id") < 10, "bad_offsets")).withColumn("tier", F.lit("fact"))
    out = grounding.gate(grounding.judged(df, judges.client_judge(connect, F.col("id").cast("string"))))
    assert out.filter("ok").count() == 10 and out.filter("NOT ok").count() == 10 and calls.value == 10


def test_failing_client_is_a_row(spark):
    def connect():
        def client(system, prompt):
            if prompt == "3":
                raise TimeoutError("late")
            return "no verd", 2

        return client

    out = judges.completed(spark.range(5).withColumn("p", F.col("id").cast("string")), "s", F.col("p"), connect).collect()
    assert [r["answer_error"] for r in out if r["id"] == 3] == ["TimeoutError: late"] and sum(r["answer_error"] is None for r in out) == 4


@pytest.mark.parametrize(("answer", "fine"), [('{"verdict": "Grounded "}', True), ('{"verdict": "maybe"}', False), ('so {"verdict": "partial"} it is', True), ('{"verdict": "groun', False), ("[1]", False), ("", False), (None, False), ('{"failing_values": "verdict"}', False)])
def test_what_is_asked_once_more(spark, answer, fine):
    assert judges.readable(answer) == fine
    row = spark.createDataFrame([(answer,)], "a string").select(jsonx.judge_answer("a").alias("j")).head()
    assert (row["j"]["verdict"] is not None) == fine


@pytest.mark.parametrize("owned", ["evidence_span", "page", "document", "provenance_validation", "source_sha256", "evidence_sha256", "source_chunk_id"])
def test_columns_of_code_are_refused(spark, owned):
    base = '"record_type": "t", "tier": "fact", "char_start": 0, "char_end": 1'
    rows = [(0, f'{{{base}, "{owned}": null}}'), (1, f'{{{base}, "{owned}": "x"}}'), (2, f'{{{base}, "record_id": "r", "flagged": true, "created": 1}}'), (3, f'{{{base}, "fields": null}}')]
    got = {r["i"]: r["reason_code"] for r in grounding.validate(grounding.begin(spark.createDataFrame(rows, "i int, payload string"))).collect()}
    assert got == {0: "schema_invalid", 1: "schema_invalid", 2: None, 3: "schema_invalid"}


def test_keywords_that_say_nothing(spark):
    words = ["the", "N/A", "none", "-", " Lump  Sum ", "x", "with", "it"]
    df = spark.createDataFrame([(words,)], "w array<string>")
    assert df.select(jsonx.cleaned_keywords("w").alias("k")).head()["k"] == ["it", "lump sum", "with"]
