"""The run flow against a local server that answers like a chat model."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from groundmill import runs, stages
from groundmill.clients import CallTimeout, chat, post_json
from groundmill.operators import grounding, judges
from groundmill.reports import runs_report
from groundmill.sources import corpus, sinks
from groundmill.tools import Store, Tools

C = [f"{i}2222222-0000-0000-0000-000000000000" for i in range(5)]
TEXTS = ["B. Smith reversed the prior approval on 2025-02-18 under mental health.", "Lump sum paid to Ann Lee on 2024-01-02.", "Broken chunk.", "Nothing here."]


def answer(system, prompt):
    if system == judges.EXTRACT_SYSTEM:
        if "Broken" in prompt:
            return None
        if "Smith" in prompt:
            return 'Here: [{"quote": "B. Smith  reversed the prior approval", "record_type": "change", "actor": "B. Smith", "fields": {"a": 1}}, {"quote": "not there", "record_type": "x"}, {"quote": "under mental health", "tier": "odd"}]'
        return json.dumps([{"quote": "paid to Ann Lee", "record_type": "payment", "actor": "Ann  Lee", "event_date": "2024-01-02", "confidence": 0.5}]) if "Ann" in prompt else "[]"
    if system == judges.JUDGE_SYSTEM:
        return '{"verdict": "ungrounded", "failing_values": ["event_date"], "reason": "no date"}' if "event_date" in prompt else '{"verdict": "grounded"}'
    if system == judges.FILL_SYSTEM:
        if "Broken" in prompt:
            return None
        if "Ann" in prompt:  # a date that the quote lacks, then a fuller quote
            return json.dumps({"quote": "paid to Ann Lee", "record_type": "payment", "event_date": "2024-01-02", "confidence": 0.4} if "rejected" not in prompt else {"quote": "Lump sum paid to Ann Lee", "record_type": "payment", "confidence": 0.7})
        return json.dumps({"quote": "nowhere", "confidence": 0.9})
    return {judges.PROSE_SYSTEM: "Prose", judges.TYPES_SYSTEM: '["Lump Sum", "payment"]', judges.MERGE_SYSTEM: '{"canonical": ["payment"], "mapping": {"lump_sum": "Payment"}}', judges.KEYWORDS_SYSTEM: '["N/A", "Lump  Sum"]'}.get(system, '{"claim_meaning": "It was paid.", "questions_answered": ["When?"]}')


@pytest.fixture(scope="module")
def url():
    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            said = answer(*(m["content"] for m in body["messages"]))
            if "slow" in self.path:
                time.sleep(2)
            self.send_response(200 if said is not None else 500)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": said}}], "usage": {"completion_tokens": 7}}).encode())

        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


@pytest.fixture
def frags(spark):
    rows = [(c, t, "d.pdf", i, "note", i) for i, (c, t) in enumerate(zip(C, TEXTS))]
    return corpus.fragments(spark.createDataFrame(rows, "chunk_id string, text string, document string, page int, chunk_type string, segment_index int"))


def judge(url):
    return judges.http_judge(url, "j", judges.record_prompt(F.col("claim"), F.col("evidence_span"), F.col("tier")))


def test_deadline(url):
    with pytest.raises(CallTimeout):
        post_json(f"{url}/slow", {"messages": [{"content": ""}, {"content": ""}]}, deadline_s=0.3)
    assert chat(url, "m", 5, 9)()(judges.PROSE_SYSTEM, "x") == ("Prose", 7)
    with pytest.raises(OSError):
        chat(url, "m", 5, 9)()(judges.EXTRACT_SYSTEM, "Broken")


def test_probe(spark, frags, url, tmp_path):
    ids = spark.createDataFrame([(c,) for c in C] + [("no id",)], "chunk_id string")
    protected = {"fragments": frags}
    got = runs.run_probe(spark, "t1", "m", ids, frags, judges.http_candidate(url, "m"), judge(url), str(tmp_path / "t1"), protected, at="2026-01-01T00:00:00+00:00", emit=lambda x: None)
    card = got["scorecard"]
    want = {"proposals": 4, "located": 3, "stored": 2, "grounded": 2, "chunks_seen": 4, "chunks_missing": 2, "chunks_with_proposals": 2, "chunks_empty": 2, "extract_errors": 1, "pass_rate": 0.6667, "yield_rate": 0.5, "smoking_gun": False}
    assert {k: card[k] for k in want} == want and got["untouched"] and got["scored_and_exported"]
    assert not spark.catalog.databaseExists("probe_t1")
    attempts = spark.read.json(str(tmp_path / "t1/attempts"))
    assert sorted(str(r["reason_code"]) for r in attempts.collect()) == ["None", "None", "locate_miss", "ungrounded_fact"]
    records = spark.read.json(str(tmp_path / "t1/records")).collect()
    assert {r["evidence_span"] for r in records} == {"B. Smith reversed the prior approval", "under mental health"} and all(r["slice_check"] == "OK" for r in records)
    audit = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "t1/audit")).collect())
    assert audit.count("FRAGMENT") == 1 and "slice OK" in audit and TEXTS[0] in audit
    assert json.loads((tmp_path / "t1/run_meta.json").read_text())["records_written"] == 2
    # a card of an older run without coverage counts as 0
    (tmp_path / "old").mkdir()
    (tmp_path / "old/scorecard.json").write_text(json.dumps({"label": "old", "candidate_model": "q", "proposals": 1, "pass_rate": 1.0}))
    text = runs_report(spark, str(tmp_path / "*/scorecard.json"))
    assert "| old | q |" in text and "0/0" in text and "### t1" in text and "2/4" in text


def test_a_run_that_breaks_keeps_its_namespace(spark, frags, url, tmp_path):
    def broken(df):
        raise ValueError("judge")

    ids = spark.createDataFrame([(C[0],)], "chunk_id string")
    with pytest.raises(ValueError):
        runs.run_probe(spark, "t2", "m", ids, frags, judges.http_candidate(url, "m"), broken, str(tmp_path / "t2"), emit=lambda x: None)
    assert spark.catalog.databaseExists("probe_t2") and not json.loads((tmp_path / "t2/isolation.json").read_text())["scored_and_exported"]
    sinks.drop_namespace(spark, "t2")


def test_stages(spark, frags, url, tmp_path):
    said, chunks = [], frags.filter(F.col("chunk_id").isin(C[:3])).select("chunk_id", "text")
    ctx = stages.Context(judges.http_candidate(url, "m"), judge(url))
    got = stages.run_stages(chunks, ctx, str(tmp_path / "s"), emit=said.append)
    assert list(got) == [s.name for s in stages.STAGES] and len(said) == 7 and "100%" in said[-1] and not any("failed" in s for s in said)
    assert [r["label"] for r in got["prose"].collect()] == ["prose"] * 3
    assert {r["term"]: r["canonical"] for r in got["merged"].collect()} == {"lump_sum": "payment", "payment": "payment"}
    assert [r["types"] for r in stages.canonical_types(got["types"], got["merged"]).collect()] == [["payment"]] * 3
    fill = {r["chunk_id"]: r for r in got["fill"].collect()}
    ann, lost, broken = fill[C[1]], fill[C[0]], fill[C[2]]
    assert ann["grounded"] and ann["attempts"] == 2 and ann["trajectory"] == [0.4, 0.7] and ann["evidence_span"] == "Lump sum paid to Ann Lee"
    # the second try does not better the first by eps, so it ends unlocated
    assert not lost["grounded"] and lost["trajectory"] == [0.9, 0.9] and lost["reason_code"] == "locate_miss" and lost["best_confidence"] == 0.9
    assert broken["error"].startswith("HTTPError") and not broken["grounded"] and broken["attempts"] == 0
    assert [r["cleaned"] for r in got["cleaned"].collect()] == [["lump sum"]] * 3
    assert got["meaning"].head()["questions_answered"] == ["When?"]
    bad = stages.run_stages(chunks, stages.Context(ctx.connect), str(tmp_path / "b"), [stages.Stage("fill", stages.fill_values), stages.STAGES[0]], emit=said.append)
    assert bad["fill"].columns == ["error"] and bad["prose"].count() == 3
    assert stages.percent(1, 4, 5, 10) == 37.5 and stages.remaining_s(10, 2, 6) == 20 and stages.percent(0, 0, 0, 0) == 0


def test_tools_write(spark, frags, tmp_path):
    none = spark.createDataFrame([], "record_id string, source_chunk_id string")
    fine = judges.rule_judge(F.lit('{"verdict": "grounded"}'))
    tools = Tools(spark, frags, none, fine, store=Store(spark, str(tmp_path / "store")))
    tools.get_chunk(C[0].upper())
    one = tools.write_enrichment({"record_type": " change ", "tier": "fact", "char_start": 0, "char_end": 8, "actor": "B.  Smith"})
    two = tools.write_enrichment({"record_type": "payment", "tier": "fact", "char_start": 0, "char_end": 4, "chunk_id": C[1], "event_date": "2024-01-02"})
    three = tools.write_enrichment({"record_type": "payment", "tier": "fact", "char_start": 5, "char_end": 8, "chunk_id": C[1], "actor": "B. Smith"})
    assert one["ok"] and one["evidence_span"] == "B. Smith" and tools.get_record("{" + one["record_id"].upper() + "}")["record_type"] == "change"
    assert tools.get_record("nonsense") is None and tools.get_record(C[4]) is None
    smith = tools.store.find_entity("actor", "B. Smith")
    assert smith["first_seen_record"] == one["record_id"] and smith["aliases"] == ["B.  Smith"] and tools.store.find_entity("actor", "X") is None
    link = lambda a, b: tools.link_events({"record_a": a["record_id"], "record_b": b["record_id"], "relation": "same_event", "tier": "fact", "rationale": "r", "evidence": {"a_span": [0, 3], "b_span": [0, 3]}})
    first, second = link(one, two), link(two, three)
    assert first["ok"] and second["event_entity"] == first["event_entity"] and first["provenance_validation"]["a_evidence_sha256"]
    assert json.loads(spark.read.parquet(str(tmp_path / "store/links")).head()["evidence"])["a_source_chunk_id"] in C
    members = tools.store.events()[0].head()["member_records"]
    assert sorted(members) == sorted(x["record_id"] for x in (one, two, three))
    assert tools.link_events({"record_a": one["record_id"], "record_b": C[4], "relation": "x", "tier": "fact", "rationale": "r", "evidence": {"a_span": [0, 3], "b_span": [0, 3]}})["reason_code"] == "unknown_record"


def test_gate_says_why(spark):
    df = grounding.begin(spark.createDataFrame([("fact", '{"verdict": "partial", "failing_values": ["date"], "reason": "no date"}')], "tier string, answer string"))
    assert grounding.gate(judges.with_verdict(df)).head()["detail"] == 'judge=partial failing_values=["date"] no date'
