import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from groundmill.common import ensure_checkpoint_dir, running
from groundmill.operators import entities, events, grounding, judges, passes, ranking, scoring
from groundmill.sources import corpus, sinks
from groundmill.streaming import attempts
from groundmill.tools import Tools

IDS = [f"{i}1111111-0000-0000-0000-000000000000" for i in range(6)]
FRAGS = [(IDS[0], "Supervisor B. Smith reversed the prior approval on 2025-02-18.", "d.pdf", 7, "note", 0), (IDS[1], "The reversal was logged.", "d.pdf", 7, "note", 1), (IDS[2], None, "d.pdf", None, None, 2), (IDS[3], "Other", "e.pdf", 8, "call", 0), (IDS[4], "Last", "d.pdf", 9, "note", None)]


@pytest.fixture
def frags(spark):
    return corpus.fragments(spark.createDataFrame(FRAGS + FRAGS[:1], "chunk_id string, text string, document string, page int, chunk_type string, segment_index int"))


def ids(df, c="chunk_id"):
    return sorted(IDS.index(r[c]) for r in df.select(c).collect())


def test_corpus(spark, frags):
    assert frags.count() == 5 and frags.filter("text = ''").count() == 1
    asked = spark.createDataFrame([(IDS[0].upper(),), ("F7-MANGLED",), ("9" * 8 + IDS[0][8:],), (None,)], "chunk_id string")
    assert [r["found"] for r in corpus.lookup(asked, frags).orderBy("f_chunk_id").collect()].count(True) == 1
    one = spark.createDataFrame([(IDS[1],)], "chunk_id string")
    assert ids(corpus.neighbours(one, frags, 1)) == [0, 1, 2]
    assert ids(corpus.neighbours(one, frags, 0)) == [1]
    assert ids(corpus.neighbours(one, frags, -1)) == []
    assert ids(corpus.neighbours(spark.createDataFrame([(IDS[4],)], "chunk_id string"), frags, 1)) == []
    assert ids(corpus.in_pages(frags, 7, 8)) == [0, 1, 3]
    lines = spark.createDataFrame([("# remark", 0), (f"  {IDS[3]} x", 1), ("", 2), (IDS[0], 3), (IDS[5], 4)], "value string, ordinal int")
    assert [IDS.index(r["chunk_id"]) for r in corpus.listed(frags, lines).collect()] == [3, 0]
    assert corpus.listed(frags, lines, keep_missing=True).count() == 3
    assert ids(corpus.slice_of(frags, one, spark.createDataFrame([(8,)], "page int"), ["LAST"])) == [1, 3, 4]
    a = frags.filter("page = 7").select("chunk_id", F.lit("a").alias("source"), F.lit(1).alias("ordinal"))
    b = frags.select("chunk_id", F.lit("b").alias("source"), F.lit(1).alias("ordinal"))
    assert sorted(r["source"] for r in corpus.first_source(a, b).collect()) == ["a", "a", "b", "b", "b"]
    seen = spark.createDataFrame([("w", "x", 3), ("w", "y", 1), ("w", "x", 0), ("v", "y", 9)], "workstream string, chunk_id string, ordinal int")
    assert {(r["workstream"], r["chunk_id"]): r["handle"] for r in corpus.first_seen_handles(seen).collect()} == {("w", "x"): "F1", ("w", "y"): "F2", ("v", "y"): "F1"}


def test_neighbours_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(f"c{i}", "t", rng.choice("ab"), 1, "n", rng.randrange(40)) for i in range(120)]
    f = spark.createDataFrame(rows, "chunk_id string, text string, document string, page int, chunk_type string, segment_index int")
    for w in (1, 3, 7):
        got = {(r["anchor_id"], r["chunk_id"]) for r in corpus.neighbours(f.select("chunk_id"), f, w).collect()}
        assert got == {(a[0], b[0]) for a in rows for b in rows if a[2] == b[2] and abs(a[5] - b[5]) <= w}


def test_tools(spark, frags):
    records = spark.createDataFrame([("11111111-aaaa-0000-0000-000000000000", IDS[0]), ("22222222-aaaa-0000-0000-000000000000", IDS[1])], "record_id string, source_chunk_id string")
    t = Tools(spark, frags, records, judges.rule_judge(F.lit('{"verdict": "grounded"}')))
    got = t.get_chunk(IDS[0])
    assert got["ok"] and got["chunk_handle"] == "F1" and t.get_chunk("nope")["reason_code"] == "fragment_not_found"
    assert [f["chunk_handle"] for f in t.get_neighbors(IDS[1])["fragments"]] == ["F1", "F2", "F3"] and t.streams.current["default"] == IDS[0]
    base = {"char_start": 0, "char_end": 28, "record_type": "status_change", "tier": "fact", "fields": {"change": "reversal"}}
    ok = t.write_enrichment(base)  # the current fragment
    assert ok["ok"] and ok["evidence_span"] == "Supervisor B. Smith reversed" and ok["provenance_validation"]["verdict"] == "grounded"
    assert t.write_enrichment(base | {"chunk_handle": "F7-MANGLED"})["reason_code"] == "unknown_fragment"
    assert t.write_enrichment(base | {"chunk_handle": "F1", "chunk_id": IDS[1]})["reason_code"] == "unknown_fragment"
    assert t.write_enrichment(base | {"char_end": 10000})["reason_code"] == "bad_offsets"
    assert t.write_enrichment(base | {"evidence_span": "x"})["reason_code"] == "schema_invalid"
    link = {"record_a": "11111111-aaaa-0000-0000-000000000000", "record_b": "{22222222-AAAA-0000-0000-000000000000}", "relation": "causes", "tier": "interpretation", "evidence": {"a_span": [0, 10], "b_span": [0, 12]}, "rationale": "r"}
    got = t.link_events(link)
    assert got["ok"] and len(got["provenance_validation"]["a_source_sha256"]) == 64
    assert t.link_events(link | {"record_a": "x"})["reason_code"] == "unknown_record"


def model(links):
    """Order-dependent clusters, one link at a time."""
    event_of, log = {}, []
    events_ = {}
    for link, a, b in links:
        x, y = event_of.get(a), event_of.get(b)
        if x is None and y is None:
            x = f"event:{link}"
            events_[x] = [f"event:{min(a, b)}", set(), None]
        elif x is None or (y is not None and x == y):
            x = y if x is None else x
        elif y is not None:
            events_[x][1] |= events_[y][1]
            for r in events_[y][1]:
                event_of[r] = x
            events_[y][1:] = [set(), x]
        for r in (a, b):
            event_of[r] = x
            events_[x][1].add(r)
        log.append((link, x))
    return {k: (v[0], tuple(sorted(v[1])), v[2]) for k, v in events_.items()}, dict(log)


@pytest.mark.parametrize("seed", range(3))
def test_event_survivors(spark, seed):
    rng = random.Random(seed)
    rows = [(f"l{i:03}", f"r{rng.randrange(40):02}", f"r{rng.randrange(40):02}") for i in range(45)]
    rows = [r for r in rows if r[1] != r[2]]
    df = spark.createDataFrame([(*r, "Same Event", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i, r in enumerate(rows)], "link_id string, record_a string, record_b string, relation string, created timestamp")
    found, steps = events.materialise(events.ordered_links(df.union(df)))
    want, log = model(rows)
    assert {r["event_id"]: (r["canonical"], tuple(r["member_records"]), r["merged_into"]) for r in found.collect()} == want
    assert {r["link_id"]: r["event_entity"] for r in steps.collect()} == log
    assert all(r["flagged"] == (r["merged_into"] is not None) for r in found.collect())


def test_chain_of_components(spark):
    pairs = spark.range(300).selectExpr("lpad(id, 4, '0') AS a", "lpad(id + 1, 4, '0') AS b")
    assert events.components(pairs).select("component").distinct().collect()[0][0] == "0000"
    assert events.components(pairs.limit(0)).count() == 0


def test_entities(spark):
    rows = [("actor", "B. Smith", "r1", 1), ("actor", "B. Smith  ", "r2", 2), ("actor", " B.  Smith", "r0", 3), ("actor", " ", "r9", 0), ("date", " 2025 ", "r1", 1), ("actor", None, "r", 1)]
    s = spark.createDataFrame(rows, "entity_type string, surface string, record_id string, ordinal int")
    got = {(r["entity_type"], r["canonical"]): (r["first_seen_record"], r["aliases"]) for r in entities.resolve_or_create(s).collect()}
    assert got == {("actor", "B. Smith"): ("r1", ["B. Smith  ", " B.  Smith"]), ("date", "2025"): ("r1", [" 2025 "]), ("actor", ""): ("r9", [" "])}
    old = spark.createDataFrame([("e1", "actor", "B. Smith", ["Bob"], None), ("e2", "actor", "Z", None, "q")], "entity_id string, entity_type string, canonical string, aliases array<string>, first_seen_record string")
    merged = {r["canonical"]: r for r in entities.resolve_or_create(s, old).collect()}
    assert merged["B. Smith"]["entity_id"] == "e1" and merged["B. Smith"]["aliases"] == ["Bob", "B. Smith  ", " B.  Smith"] and merged["Z"]["aliases"] == [] and len(merged) == 4


def test_scores(spark):
    a = spark.createDataFrame([("c1", True, True, None), ("c1", True, False, "ungrounded_fact"), ("c2", False, False, "locate_miss")], "chunk_id string, located boolean, ok boolean, reason_code string")
    r = spark.createDataFrame([("r1", "c1", "grounded", False, [("actor", "e", "actor", "x")]), ("r2", "c2", "grounded", True, [("actor", "{E}", "actor", "x")])], "record_id string, source_chunk_id string, verdict string, flagged boolean, entity_refs array<struct<role:string,entity_id:string,entity_type:string,canonical:string>>")
    c = scoring.scorecard(a, r.limit(1), chunks_seen=5, wall_s=60.0).head()
    assert (c["pass_rate"], c["chunks_empty"], c["records_per_minute"], c["locate_miss"], c["yield_rate"]) == (0.5, 3, 1.0, 1, 0.3333)
    assert scoring.scorecard(a, r).head()["cross_context_entities"] == 1
    assert scoring.scorecard(a.limit(0), r.limit(0)).head()["pass_rate"] == 0
    f = spark.createDataFrame([(True,), (False,), (True,), (None,)], "grounded boolean")
    assert tuple(scoring.faithfulness(f).head()) == (4, 2, 2, 0.5)


def test_plateau(spark):
    t = spark.createDataFrame([("a", 1, 0.6), ("a", 2, 0.7), ("a", 3, 0.72), ("b", 1, 0.1), ("b", 2, 0.9), ("c", 1, float("nan"))], "chunk_id string, n int, confidence double")
    assert {r["chunk_id"]: r["stopped_at"] for r in passes.plateau(t).collect()} == {"a": 3, "b": None, "c": None}


def test_passes(spark):
    chunks = spark.createDataFrame([("a", ["THE", " Long  COVID ", "x"]), ("b", ["of"]), ("c", None)], "chunk_id string, keywords array<string>")
    assert {r["chunk_id"]: r["cleaned"] for r in passes.clean_chunks(chunks).collect()} == {"a": ["long covid"], "b": [], "c": []}
    vocab = passes.vocabulary(chunks, "keywords")
    m = spark.createDataFrame([("of", "Of Course")], "raw string, canonical string")
    assert {r["term"]: r["canonical"] for r in passes.consolidate(vocab, m).collect()}["of"] == "of_course"
    got = passes.review(chunks.select("chunk_id"), one=chunks, two=chunks.limit(0)).orderBy("chunk_id").collect()
    assert got[0]["one"]["keywords"][0] == "THE" and got[0]["two"] is None


def test_write_once(spark, tmp_path):
    rows = spark.createDataFrame([("A", 1)], "record_id string, x int")
    sinks.append_once(rows, str(tmp_path / "t"), "record_id")
    sinks.append_once(rows.withColumn("record_id", F.lit("B")), str(tmp_path / "t"), "record_id")
    with pytest.raises(sinks.WriteOnceError):
        sinks.append_once(rows.withColumn("record_id", F.lit("{a}")), str(tmp_path / "t"), "record_id")
    with pytest.raises(sinks.WriteOnceError):
        sinks.append_once(rows.union(rows), str(tmp_path / "u"), "record_id")
    with pytest.raises(ValueError):
        sinks.qualified("a; drop", "t")
    before = sinks.table_counts({"t": spark.read.parquet(str(tmp_path / "t"))})
    assert before == {"t": 2}
    with pytest.raises(RuntimeError):
        sinks.assert_isolated(before, {"t": 3})


def test_supersede_and_tamper(spark, frags):
    r = spark.createDataFrame([("r1", None), ("r2", "{R1}")], "record_id string, supersedes string")
    assert [x["record_id"] for x in sinks.current(r).collect()] == ["r2"]
    rec = frags.filter(F.col("chunk_id") == IDS[0]).select(F.lit("r").alias("record_id"), F.col("chunk_id").alias("source_chunk_id"), F.lit(0).alias("char_start"), F.lit(10).alias("char_end"), F.lit("Supervisor").alias("evidence_span"), F.struct(F.sha2("text", 256).alias("source_sha256"), F.sha2(F.lit("Supervisor"), 256).alias("evidence_sha256")).alias("provenance_validation"))
    assert not any(grounding.tampered(rec, frags).drop("record_id").head())
    changed = frags.withColumn("text", F.concat("text", F.lit("!")))
    assert grounding.tampered(rec, changed).head()["source_changed"] and not grounding.tampered(rec, changed).head()["span_moved"]


def test_streams(spark, tmp_path):
    src, t0 = tmp_path / "in", dt.datetime(2024, 1, 1)
    schema = "id string, at timestamp, ok boolean, entity_type string, surface string, record_id string, ordinal int"
    rows = [("p1", t0, True, "actor", "A", "r1", 1), ("p1", t0, True, "actor", "A ", "r2", 2), ("p2", t0 + dt.timedelta(minutes=2), False, "actor", "B", "r3", 3)]
    spark.createDataFrame(rows, schema).write.parquet(str(src))
    stream = spark.readStream.schema(schema).parquet(str(src))
    attempts.once(stream, "id").writeStream.format("memory").queryName("once").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("once").count() == 2
    attempts.heartbeat(stream).writeStream.outputMode("complete").format("memory").queryName("beat").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r["attempts"], r["accepted"]) for r in spark.table("beat").collect()) == [(1, 0), (2, 2)]
    stream.writeStream.foreachBatch(attempts.entity_log(str(tmp_path / "e"))).trigger(availableNow=True).start().awaitTermination()
    assert {r["canonical"]: r["aliases"] for r in attempts.entities_of(spark, str(tmp_path / "e")).collect()} == {"A": ["A "], "B": []}
    # a later batch that adds a spelling, run twice, changes nothing that is written
    late = spark.createDataFrame([("p3", t0, True, "actor", " A", "r0", 9)], schema)
    for _ in range(2):
        attempts.entity_log(str(tmp_path / "e"))(late, 7)
    assert {r["canonical"]: r["aliases"] for r in attempts.entities_of(spark, str(tmp_path / "e")).collect()} == {"A": ["A ", " A"], "B": []}


def test_rank(spark):
    v = {1: [1.0, 0.0], 2: [1.0, 1.0], 3: [2.0, 0.0], 4: None, 5: [], 6: [0.0, 0.0], 7: [1.0, 0.0, 0.0], 8: [float("nan"), 1.0], 100: [3.0, 0.1]}
    rows = spark.createDataFrame([(i, x) for i, x in v.items()] + [(3, v[3])], "id int, v array<float>")
    got = ranking.rank_by_cosine(rows.filter("id IN (1, 4, 100)"), rows, "id", "v", 3).orderBy("query", "rank").collect()
    assert [(r["query"], r["id"], r["rank"]) for r in got] == [(1, 1, 1), (1, 3, 2), (1, 100, 3), (100, 100, 1), (100, 1, 2), (100, 3, 3)]
    assert ranking.rank_by_cosine(rows.limit(0), rows, "id", "v", 3).count() == 0


def test_running_sums_of_a_hot_group(spark):
    rows = [(None if i % 7 == 0 else "hot" if i % 3 else "g", i, i % 5) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, i int, x int").repartition(6)
    got = {(r["g"], r["i"]): (r["n"], r["total"]) for r in running(df, ["g"], ["i"], {"n": F.lit(1), "total": F.col("x")}).collect()}
    for g in (None, "hot", "g"):
        total = 0
        for n, (_, i, x) in enumerate(sorted(r for r in rows if r[0] == g), 1):
            total += x
            assert got[g, i] == (n, total)


def test_rounding_is_pythons(spark):
    xs = [1 / 32, 3 / 32, 1 / 20000, 0.00015, 2.675, 0.5, 1.00005, 2 / 3, 0.0, 1.0, 86 / 99, 0.12345, 0.99995]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", scoring.half_even(F.col("x"), 4).alias("a"), scoring.half_even(F.col("x"), 2).alias("b")).collect()
    assert all((r["a"], r["b"]) == (round(r["x"], 4), round(r["x"], 2)) for r in got)


def test_ids_in_one_form(spark, frags):
    one = IDS[0]
    for spelled in (one.upper(), "{" + one + "}", "urn:uuid:" + one, one.replace("-", ""), f"  {one} "):
        assert corpus.lookup(spark.createDataFrame([(spelled,)], "chunk_id string"), frags).head()["found"], spelled
    assert not corpus.lookup(spark.createDataFrame([(one[:-1],)], "chunk_id string"), frags).head()["found"]


def test_many_page_ranges(spark, frags):
    names = spark.createDataFrame([(f"f{i}_1-{10**9}.pdf",) for i in range(100_050)] + [("g_5-2.pdf",), ("h.pdf",)], "name string")
    pages = frags.filter("page >= 1").count()
    assert corpus.in_file_pages(frags, names).count() == 100_050 * pages and pages > 0


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as N

    none = N(isDefined=lambda: False)
    fake = N(sparkContext=N(_jsc=N(sc=lambda: N(getCheckpointDir=lambda: none)), getConf=lambda: {}, master="spark://host:7077"), conf={})
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(fake)


REFS = "record_id string, source_chunk_id string, entity_refs array<struct<role:string,entity_id:string,entity_type:string,canonical:string>>"


def test_candidates_of_neighbouring_segments(spark, frags):
    e = lambda *ids: [("actor", i, "actor", i) for i in ids]
    records = spark.createDataFrame([("r1", IDS[0], None), ("R2", IDS[1], e("x")), ("r3", IDS[2], []), ("r4", IDS[3], e("x")), ("r5", IDS[1], None), ("r6", IDS[5], None)], REFS)
    got = {(r["record_a"], r["record_b"]): (r["shared"], r["adjacent"]) for r in entities.candidates(records.union(records), frags).collect()}
    assert got == {p: (0, True) for p in (("r1", "r2"), ("r1", "r5"), ("r2", "r3"), ("r3", "r5"), ("r2", "r5"))}  # x is a theme of so few fragments
    edges = spark.createDataFrame([(f"r{i:02}", f"c{i % 2}", "x") for i in range(25)] + [(f"s{i}", f"d{i}", "y") for i in range(60)], "record_id string, chunk_id string, entity_id string")
    assert {tuple(r) for r in entities.fan_out_cut(edges, 20).collect()} == {("x", 25, 300, 10)}
    assert entities.candidate_pairs(edges, 20).count() == 290


def test_walk_from_a_chunk(spark):
    edges = spark.createDataFrame([("r1", "c1", "x"), ("r2", "c2", "x"), ("r3", "c3", "y")], "record_id string, chunk_id string, entity_id string")
    records = spark.createDataFrame([(f"R{i}",) for i in range(1, 6)], "record_id string")
    links = spark.createDataFrame([("r4", "{R2}"), ("r4", "r5"), ("r4", "r9"), ("r9", "r3")], "record_a string, record_b string")
    go = lambda v, c, steps=2: {r["record_id"]: r["steps"] for r in entities.walk(spark.createDataFrame([(v,)], f"{c} string"), edges, links, records, steps).collect()}
    assert go("C1", "chunk_id") == {"r1": 0, "r2": 0, "r4": 1, "r5": 2}
    assert go("x", "entity_id", 1) == {"r1": 0, "r2": 0, "r4": 1}
    assert go("r5", "record_id", 1) == {"r5": 0, "r4": 1} and go("none", "chunk_id") == {}


def test_cooccurrence(spark):
    rows = [("r1", "c1", "x"), ("r1", "c1", "y"), ("r2", "c1", "z"), ("r3", "c2", "x"), ("r3", "c2", "y"), ("r4", None, "x"), ("r4", None, "z")]
    edges = spark.createDataFrame(rows, "record_id string, chunk_id string, entity_id string")
    want = {("x", "y"): (2, 2), ("x", "z"): (1, 1), ("y", "z"): (0, 1)}
    for part in (1, 200):
        got = {(r["entity_id"], r["other_id"]): (r["records"], r["chunks"]) for r in entities.cooccurrence(edges, part).collect()}
        assert got == want | {k[::-1]: v for k, v in want.items()}
