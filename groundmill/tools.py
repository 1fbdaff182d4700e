"""The four tools as calls: one request in, one answer out. A thin layer over the set-based stages for interactive use;
pipelines use the stages directly."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill import runs
from groundmill.common import durable
from groundmill.functions import text
from groundmill.functions.text import uuid_key
from groundmill.operators import entities, events, grounding
from groundmill.operators import links as link_ops
from groundmill.sources import corpus, sinks


class Workstreams:
    """Handles of fragments and the current fragment, by workstream; small driver-side state."""

    def __init__(self) -> None:
        self.handles: dict[tuple[str, str], str] = {}
        self.current: dict[str, str] = {}

    def mint(self, workstream: str, chunk_id: str) -> str:
        known = {h: c for (w, h), c in self.handles.items() if w == workstream}
        for h, c in known.items():
            if c == chunk_id:
                return h
        handle = f"F{len(known) + 1}"
        self.handles[workstream, handle] = chunk_id
        return handle

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(w, h, c) for (w, h), c in self.handles.items()]
        return spark.createDataFrame(rows, "workstream string, handle string, chunk_id string")


class Store:
    """Append-only tables of records and links under a folder; entities and events are folded of them when they are read."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{name}")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    def add(self, name: str, rows: DataFrame, key: str) -> None:
        sinks.append_once(rows, f"{self.root}/{name}", key)

    def entities(self, existing: DataFrame | None = None) -> DataFrame | None:
        records = self.read("records")
        return None if records is None else entities.resolve_or_create(runs.surfaces(records), existing)

    def find_entity(self, entity_type: str, canonical: str) -> dict | None:
        held = self.entities()
        rows = held.filter((F.col("entity_type") == entity_type) & (F.col("canonical") == canonical)).limit(1).collect() if held is not None else []
        return rows[0].asDict() if rows else None

    def events(self) -> tuple[DataFrame, DataFrame] | None:
        """(events, event of each link) of the stored same_event links in the order they were written."""
        held = self.read("links")
        return None if held is None else events.materialise(events.ordered_links(held))


class Tools:
    """``store``: where accepted records and links are written; without one nothing is kept."""

    def __init__(self, spark: SparkSession, frags: DataFrame, records: DataFrame, judge, judge_model: str = "replay", judge_version: str = "1", at: str = "1970-01-01T00:00:00+00:00", store: Store | None = None):
        self.spark, self.frags, self._records, self.judge, self.store = spark, frags, records, judge, store
        self.stamp, self.streams = (judge_model, judge_version, at), Workstreams()

    @property
    def records(self) -> DataFrame:
        own = self.store.read("records") if self.store else None
        ids = ["record_id", "source_chunk_id"]
        return self._records.select(*ids) if own is None else self._records.select(*ids).unionByName(own.select(*ids))

    def get_record(self, record_id: str) -> dict | None:
        own = self.store.read("records") if self.store else None
        rows = sinks.get_record(self._records if own is None else own, self.spark.createDataFrame([(record_id,)], "record_id string")).filter("r_record_id IS NOT NULL").limit(1).collect()
        return {k.removeprefix("r_"): v for k, v in rows[0].asDict(recursive=True).items() if k.startswith("r_")} if rows else None

    def _present(self, row, workstream: str) -> dict:
        return {"chunk_handle": self.streams.mint(workstream, row["chunk_id"]), "chunk_id": row["chunk_id"], "text": row["text"], "document": row["document"], "page": row["page"]}

    def get_chunk(self, chunk_id: str, workstream_id: str = "default") -> dict:
        ids = self.spark.createDataFrame([(chunk_id,)], "chunk_id string")
        rows = self.frags.join(ids.select(uuid_key("chunk_id").alias("chunk_id")), "chunk_id", "left_semi").limit(1).collect()
        if not rows:
            return {"ok": False, "reason_code": "fragment_not_found"}
        self.streams.current[workstream_id] = rows[0]["chunk_id"]
        return {"ok": True, **self._present(rows[0], workstream_id)}

    def get_neighbors(self, chunk_id: str, window: int = 1, workstream_id: str = "default") -> dict:
        """Does not change the current fragment."""
        anchors = self.spark.createDataFrame([(chunk_id,)], "chunk_id string")
        rows = corpus.neighbours(anchors, self.frags, window).orderBy("segment_index").collect()
        if not rows:
            return {"ok": False, "reason_code": "fragment_not_found"}
        return {"ok": True, "fragments": [self._present(r, workstream_id) for r in rows]}

    def write_enrichment(self, payload: dict, workstream_id: str = "default") -> dict:
        p = {"fields": {}, **{k: v for k, v in payload.items() if v is not None}}
        row = (workstream_id, json.dumps(p), p.get("chunk_handle"), p.get("chunk_id"), self.streams.current.get(workstream_id))
        df = self.spark.createDataFrame([row], "workstream string, payload string, chunk_handle string, chunk_id string, current_id string")
        df = grounding.validate(grounding.begin(df))
        df = df.select("*", F.from_json("payload", "char_start int, char_end int, record_type string, tier string, actor string, event_date string, claim_relevance string, confidence double").alias("p"), F.get_json_object("payload", "$.fields").alias("fields")).select("*", "p.*").drop("p")
        df = grounding.cut(grounding.load(grounding.resolve(df, self.streams.frame(self.spark)), self.frags))
        df = df.withColumn("claim", grounding.claim(F.col("actor"), F.col("event_date"), F.col("fields"), F.col("claim_relevance"), F.col("tier"), F.trim("record_type")))
        df = grounding.attest(grounding.gate(grounding.judged(df, self.judge)), *self.stamp)
        refs = grounding.entity_refs(F.col("actor"), entities.content_id(F.lit("actor"), text.normalize_actor("actor")), F.col("event_date"), entities.content_id(F.lit("date"), text.strip("event_date")))
        df = durable(df.withColumns({"record_id": F.lit(str(uuid.uuid4())), "entity_refs": refs, "record_type": text.strip("record_type"), "fields": F.coalesce("fields", F.lit("{}")), "source_chunk_id": F.col("resolved_id"), "page": F.col("source_page"), "document": F.col("source_document"), "created": F.current_timestamp(), "supersedes": F.lit(None).cast("string")}))
        r = df.collect()[0]
        if not r["ok"]:
            return {"ok": False, "reason_code": r["reason_code"], "detail": r["detail"]}
        if self.store:
            self.store.add("records", df.select(*runs.RECORD), "record_id")
        return {"ok": True, "record_id": r["record_id"], "source_chunk_id": r["resolved_id"], "evidence_span": r["evidence_span"], "provenance_validation": r["provenance_validation"].asDict(), "flagged": r["flagged"]}

    def link_events(self, payload: dict, workstream_id: str = "default") -> dict:
        df = self.spark.createDataFrame([(json.dumps(payload),)], "payload string")
        df = link_ops.validate(grounding.begin(df)).select("*", F.from_json("payload", "record_a string, record_b string, relation string, tier string, rationale string, confidence double").alias("p"), F.get_json_object("payload", "$.evidence").alias("evidence")).select("*", "p.*").drop("p")
        df = link_ops.with_spans(link_ops.with_ends(df, self.records, self.frags))
        df = link_ops.attest(link_ops.hashes(grounding.gate(grounding.judged(df, self.judge), "ungrounded_relation", "ungrounded_relation")), *self.stamp)
        df = durable(df.withColumns({"link_id": F.lit(str(uuid.uuid4())), "relation": text.strip("relation"), "created": F.current_timestamp(), "event_entity": F.lit(None).cast("string")}))
        r = df.collect()[0]
        if not r["ok"]:
            return {"ok": False, "reason_code": r["reason_code"], "detail": r["detail"]}
        out = {"ok": True, "link_id": r["link_id"], "relation": r["relation"], "provenance_validation": r["provenance_validation"].asDict(), "flagged": r["flagged"]}
        if self.store:
            self.store.add("links", df.select(*link_ops.LINK), "link_id")
            if r["relation"] == "same_event":
                mine = self.store.events()[1].filter(F.col("link_id") == r["link_id"]).collect()
                out["event_entity"] = mine[0]["event_entity"]
        return out
