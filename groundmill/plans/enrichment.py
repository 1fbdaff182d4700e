"""Queries over whole tables for the operators of grounded enrichment, each with an oracle in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.common import norm_id, table
from groundmill.functions import jsonx, text
from groundmill.operators import entities, events, grounding, judges, links, passes, ranking, scoring, substance
from groundmill.sources import corpus, sinks

Q: dict = {}
SQL: dict[str, str] = {}

# SQL pieces. B: any blank; N: an id in normal form.
_B = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}\x{000B}\x{001C}-\x{001F}]"
_N = lambda c: rf"regexp_replace(regexp_replace(lower({c}), '^[\s{{}}]+', ''), '[\s{{}}]+$', '')"
_STRIP = lambda c: f"regexp_replace(regexp_replace({c}, '^{_B}+', ''), '{_B}+$', '')"
_COLLAPSE = lambda c: _STRIP(f"regexp_replace({c}, '{_B}+', ' ', 'g')")
_FRAG = f"frag AS (SELECT DISTINCT {_N('chunk_id')} AS chunk_id, coalesce(text, '') AS text, document, page, chunk_type, segment_index FROM fragments)"


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _fragments(spark: SparkSession, d: str) -> DataFrame:
    return corpus.fragments(table(spark, d, "fragments"))


def _records(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "enrichment_records").dropDuplicates(["record_id"])


def _links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "enrichment_links").dropDuplicates(["link_id"])


def _proposals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extraction_proposals").dropDuplicates(["proposal_id"])


# --- corpus ---------------------------------------------------------------------------------------------------------


@query("fragment_lookup", f"WITH {_FRAG} SELECT p.proposal_id, f.chunk_id IS NOT NULL AS found, length(f.text) AS chars, f.document FROM (SELECT DISTINCT proposal_id, chunk_id FROM extraction_proposals) p LEFT JOIN frag f ON {_N('p.chunk_id')} = f.chunk_id")
def fragment_lookup(spark, d):
    got = corpus.lookup(_proposals(spark, d).select("proposal_id", "chunk_id"), _fragments(spark, d))
    return got.select("proposal_id", "found", F.length("f_text").alias("chars"), F.col("f_document").alias("document"))


@query("neighbours", f"WITH {_FRAG} SELECT a.chunk_id AS anchor_id, b.chunk_id, b.segment_index FROM frag a JOIN frag b ON a.document = b.document AND b.segment_index BETWEEN a.segment_index - 2 AND a.segment_index + 2")
def neighbours(spark, d):
    f = _fragments(spark, d)
    return corpus.neighbours(f.select("chunk_id"), f, 2).select("anchor_id", "chunk_id", "segment_index")


@query("page_range", f"WITH {_FRAG} SELECT chunk_id, page, segment_index, 'pdf:file_2-4.pdf' AS source FROM frag WHERE page BETWEEN 2 AND 4 UNION ALL SELECT chunk_id, page, segment_index, 'pdf:file_7-7.pdf' FROM frag WHERE page = 7")
def page_range(spark, d):
    names = spark.createDataFrame([("file_2-4.pdf",), ("file_7-7.pdf",), ("no_range.pdf",)], "name string")
    return corpus.in_file_pages(_fragments(spark, d), names).select("chunk_id", "page", "segment_index", "source")


@query("slice_ids", f"WITH {_FRAG} SELECT chunk_id FROM frag WHERE segment_index = 0 UNION SELECT chunk_id FROM frag WHERE page IN (1, 5) UNION SELECT chunk_id FROM frag WHERE text ILIKE '%deposition%' OR text ILIKE '%overpayment%'")
def slice_ids(spark, d):
    f = _fragments(spark, d)
    return corpus.slice_of(f, f.filter("segment_index = 0").select("chunk_id"), spark.createDataFrame([(1,), (5,)], "page int"), ["deposition", "overpayment"])


@query("first_source", f"WITH {_FRAG}, u AS (SELECT chunk_id, 'slice' AS source, 0 AS p, segment_index AS o FROM frag WHERE chunk_type = 'note' UNION ALL SELECT chunk_id, 'pages', 1, segment_index FROM frag WHERE page <= 3) SELECT chunk_id, source FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY p, o) AS n FROM u) WHERE n = 1")
def first_source(spark, d):
    f = _fragments(spark, d).withColumn("ordinal", F.col("segment_index"))
    one = f.filter("chunk_type = 'note'").select("chunk_id", F.lit("slice").alias("source"), "ordinal")
    two = f.filter("page <= 3").select("chunk_id", F.lit("pages").alias("source"), "ordinal")
    return corpus.first_source(one, two).select("chunk_id", "source")


@query("handles", f"WITH m AS (SELECT DISTINCT proposal_id, left(document, 3) AS workstream, {_N('p.chunk_id')} AS chunk_id, proposed_at FROM extraction_proposals p JOIN (SELECT DISTINCT {_N('chunk_id')} AS c, document FROM fragments) f ON {_N('p.chunk_id')} = f.c), g AS (SELECT workstream, chunk_id, min(proposed_at) AS t FROM m GROUP BY ALL) SELECT workstream, chunk_id, 'F' || row_number() OVER (PARTITION BY workstream ORDER BY t, chunk_id) AS handle FROM g")
def handles(spark, d):
    p = _proposals(spark, d).select(norm_id("chunk_id").alias("chunk_id"), F.col("proposed_at").alias("ordinal"))
    f = _fragments(spark, d).select("chunk_id", F.substring("document", 1, 3).alias("workstream"))
    return corpus.first_seen_handles(p.join(f, "chunk_id")).select("workstream", "chunk_id", "handle")


# --- text and JSON --------------------------------------------------------------------------------------------------


@query("normalised_types", f"SELECT record_type, regexp_replace(regexp_replace(lower({_STRIP('record_type')}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS norm, count(*) AS n FROM enrichment_records GROUP BY ALL")
def normalised_types(spark, d):
    return table(spark, d, "enrichment_records").groupBy("record_type").agg(F.count("*").alias("n")).withColumn("norm", text.normalize_type("record_type"))


@query("clean_keywords", f"WITH w AS (SELECT DISTINCT {_N('chunk_id')} AS chunk_id, unnest(string_split_regex(text, '{_B}+')) AS k FROM fragments WHERE text IS NOT NULL), c AS (SELECT chunk_id, {_COLLAPSE('lower(k)')} AS k FROM w) SELECT chunk_id, list_sort(list(DISTINCT k)) AS keywords FROM c WHERE length(k) >= 2 AND k NOT IN ('the','a','an','and','or','of','to','in','on','for','n/a','none','-') GROUP BY 1")
def clean_keywords(spark, d):
    words = _fragments(spark, d).select("chunk_id", F.split("text", rf"(?U){text.BLANK}+").alias("keywords"))
    return passes.clean_chunks(words).select("chunk_id", F.col("cleaned").alias("keywords")).filter(F.size("keywords") > 0)


@query("actor_spellings", f"SELECT {_COLLAPSE('actor')} AS actor, count(DISTINCT actor) AS spellings, count(*) AS n FROM enrichment_records WHERE {_COLLAPSE('actor')} <> '' AND lower({_STRIP('actor')}) <> 'null' GROUP BY 1")
def actor_spellings(spark, d):
    r = table(spark, d, "enrichment_records").filter(text.none_if_blank("actor").isNotNull())
    return r.groupBy(text.normalize_actor("actor").alias("actor")).agg(F.count_distinct("actor").alias("spellings"), F.count("*").alias("n"))


@query("json_fields", "SELECT record_type, json_extract_string(fields, '$.change') AS change, count(*) AS n, sum(TRY_CAST(json_extract_string(fields, '$.n') AS BIGINT))::BIGINT AS total FROM enrichment_records GROUP BY ALL")
def json_fields(spark, d):
    v = jsonx.json_object("fields")
    r = table(spark, d, "enrichment_records").select("record_type", F.try_variant_get(v, "$.change", "string").alias("change"), F.try_variant_get(v, "$.n", "bigint").alias("k"))
    return r.groupBy("record_type", "change").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query("event_props", "SELECT event_type, count(*) AS n, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS k FROM events GROUP BY 1")
def event_props(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")).alias("k"))


@query("prose_labels", "SELECT chunk_type, CASE WHEN t LIKE '%non_prose%' OR t LIKE 'non%' OR t NOT LIKE '%prose%' THEN 'non_prose' ELSE 'prose' END AS label, count(*) AS n FROM (SELECT chunk_type, CASE WHEN chunk_type IN ('note', 'call') THEN 'Prose' ELSE 'Non-prose.' END AS raw, lower(CASE WHEN chunk_type IN ('note', 'call') THEN 'Prose' ELSE 'Non-prose.' END) AS t FROM fragments) GROUP BY ALL")
def prose_labels(spark, d):
    raw = F.when(F.col("chunk_type").isin("note", "call"), "Prose").otherwise("Non-prose.")
    return table(spark, d, "fragments").withColumn("label", text.parse_prose_label(raw)).groupBy("chunk_type", "label").agg(F.count("*").alias("n"))


# --- grounding ------------------------------------------------------------------------------------------------------

#: Verdicts of the replay: by the first digit of the proposal id's md5, the last two standing for a judge without answer.
_ANSWER_SQL = "CASE WHEN md5(proposal_id)[1] IN ('e', 'f') THEN NULL WHEN md5(proposal_id)[1] IN ('a', 'b') THEN 'ungrounded' WHEN md5(proposal_id)[1] IN ('8', '9') THEN 'partial' ELSE 'grounded' END"


def _replay(df: DataFrame) -> DataFrame:
    digit = F.substring(F.md5("proposal_id"), 1, 1)
    verdict = F.when(digit.isin("e", "f"), "no answer").when(digit.isin("a", "b"), '{"verdict": "Ungrounded", "failing_values": "date"}').when(digit.isin("8", "9"), 'So: {"verdict": "partial"}').otherwise('{"verdict": "grounded", "failing_values": []}')
    return judges.rule_judge(verdict)(df)


def located(spark: SparkSession, d: str) -> DataFrame:
    p = grounding.begin(_proposals(spark, d).withColumn("resolved_id", norm_id("chunk_id")))
    return grounding.locate(grounding.load(p, _fragments(spark, d)))


def grounded(spark: SparkSession, d: str) -> DataFrame:
    """Attempts: every proposal with its outcome."""
    return grounding.gate(grounding.judged(grounding.without_text(grounding.cut(located(spark, d))), _replay))


_LOCATED_SQL = f"""
WITH {_FRAG}, p AS (SELECT DISTINCT ON (proposal_id) *, {_STRIP('quote')} AS q FROM extraction_proposals),
j AS (SELECT p.*, f.chunk_id AS fid, f.text, f.document AS fdoc FROM p LEFT JOIN frag f ON {_N('p.chunk_id')} = f.chunk_id),
m AS (SELECT *, CASE WHEN q <> '' AND instr(text, q) > 0 THEN instr(text, q) - 1 END AS s0,
  CASE WHEN q <> '' THEN regexp_extract(text, array_to_string(list_transform(string_split_regex(q, '{_B}+'), lambda w: regexp_escape(w)), '{_B}+')) END AS loose FROM j),
l AS (SELECT *, coalesce(s0, CASE WHEN loose <> '' THEN instr(text, loose) - 1 END) AS char_start, CASE WHEN s0 IS NOT NULL THEN s0 + length(q) WHEN loose <> '' THEN instr(text, loose) - 1 + length(loose) END AS char_end FROM m)
"""
_ATTEMPT_SQL = _LOCATED_SQL + f""", v AS (SELECT *, {_ANSWER_SQL} AS answer, char_start IS NOT NULL AS hit FROM l),
a AS (SELECT *, CASE WHEN hit THEN answer END AS verdict,
  CASE WHEN fid IS NULL THEN 'fragment_not_found' WHEN NOT hit THEN 'locate_miss' WHEN answer IS NULL THEN 'judge_unavailable'
    WHEN tier = 'fact' AND answer <> 'grounded' THEN 'ungrounded_fact' WHEN tier <> 'fact' AND answer = 'ungrounded' THEN 'unsupported_interpretation' END AS reason_code FROM v)
"""


@query("locate_quotes", _LOCATED_SQL + "SELECT proposal_id, coalesce(char_start, -1)::INT AS char_start, coalesce(char_end, -1)::INT AS char_end, substring(text, char_start + 1, char_end - char_start) AS span FROM l")
def locate_quotes(spark, d):
    s = F.substring(F.col("source_text"), F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    at = lambda c: F.coalesce(c, F.lit(-1)).alias(c)
    return located(spark, d).select("proposal_id", at("char_start"), at("char_end"), s.alias("span"))


@query("ground_proposals", _ATTEMPT_SQL + "SELECT proposal_id, tier, verdict, reason_code, reason_code IS NULL AS ok, coalesce(reason_code IS NULL AND verdict = 'partial', false) AS flagged FROM a")
def ground_proposals(spark, d):
    return grounded(spark, d).select("proposal_id", "tier", "verdict", "reason_code", "ok", F.coalesce("flagged", F.lit(False)).alias("flagged"))


@query("rejection_counts", _ATTEMPT_SQL + "SELECT tier, coalesce(reason_code, 'accepted') AS outcome, count(*) AS n FROM a GROUP BY ALL")
def rejection_counts(spark, d):
    return grounded(spark, d).groupBy("tier", F.coalesce("reason_code", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n"))


@query("attested_records", _ATTEMPT_SQL + "SELECT proposal_id, verdict, sha256(substring(text, char_start + 1, char_end - char_start)) AS evidence_sha256, sha256(text) AS source_sha256, fdoc AS document FROM a WHERE reason_code IS NULL")
def attested_records(spark, d):
    r = grounding.attest(grounded(spark, d), "replay", "1", "2026-01-01T00:00:00+00:00").filter("ok")
    return r.select("proposal_id", "provenance_validation.verdict", "provenance_validation.evidence_sha256", "provenance_validation.source_sha256", F.col("source_document").alias("document"))


@query("tamper_audit", f"""WITH {_FRAG}, r AS (SELECT DISTINCT ON (record_id) * FROM enrichment_records)
SELECT {_N('record_id')} AS record_id, f.chunk_id IS NULL AS source_missing, coalesce(sha256(f.text) <> provenance_validation.source_sha256, false) AS source_changed, sha256(evidence_span) <> provenance_validation.evidence_sha256 AS span_changed,
coalesce(substring(f.text, char_start + 1, char_end - char_start) <> evidence_span, false) AS span_moved FROM r LEFT JOIN frag f ON {_N('r.source_chunk_id')} = f.chunk_id""")
def tamper_audit(spark, d):
    return grounding.tampered(_records(spark, d), _fragments(spark, d))


@query("claims", """WITH r AS (SELECT DISTINCT ON (record_id) * FROM enrichment_records), k AS (SELECT record_id, list_sort(json_keys(fields)) AS ks FROM r),
c AS (SELECT r.record_id, concat_ws('; ', 'actor: ' || nullif(actor, ''), 'event_date: ' || nullif(event_date, ''),
 CASE WHEN len(ks) > 0 THEN 'details: {' || array_to_string(list_transform(ks, lambda x: '"' || x || '": ' || json_extract(fields, '$.' || x)::VARCHAR), ', ') || '}' END,
 CASE WHEN tier = 'interpretation' THEN 'relevance: ' || nullif(claim_relevance, '') END) AS c, record_type FROM r JOIN k USING (record_id))
SELECT record_id, CASE WHEN c <> '' THEN c ELSE 'the span records a ' || record_type || ' event' END AS claim FROM c""")
def claims(spark, d):
    r = _records(spark, d)
    return r.select("record_id", grounding.claim(F.col("actor"), F.col("event_date"), F.col("fields"), F.col("claim_relevance"), F.col("tier"), F.col("record_type")).alias("claim"))


@query("payload_validation", """WITH p AS (SELECT DISTINCT ON (proposal_id) * FROM extraction_proposals), h AS (SELECT *, md5(proposal_id)[2] AS x FROM p)
SELECT CASE WHEN x = '0' THEN ['evidence_span', 'page', 'document', 'provenance_validation', 'source_sha256', 'evidence_sha256', 'source_chunk_id'][1 + ascii(md5(proposal_id)[4]) % 7] || ' is set by code' WHEN x = '1' THEN 'record_type must be text' WHEN x = '2' THEN 'tier must be fact or interpretation' WHEN x = '3' THEN 'char_start must be a whole number'
 WHEN x = '4' THEN 'confidence must be a number from 0 to 1' ELSE 'valid' END AS problem, count(*) AS n FROM h GROUP BY 1""")
def payload_validation(spark, d):
    """Payloads made of proposals, some broken by a digit of the id's md5: each column that code owns is forged in turn, sometimes
    with a null; some leave out fields, and a few carry columns that a model may send."""
    x = F.substring(F.md5("proposal_id"), 2, 1)
    s = F.struct(
        F.lit("r").alias("record_id"), F.when(x == "1", " ").otherwise(F.col("record_type")).alias("record_type"), F.when(x == "2", "guess").otherwise(F.col("tier")).alias("tier"),
        F.lit(9).alias("char_end"), F.when(x == "4", 1.5).otherwise(F.col("confidence")).alias("confidence"), "actor", "event_date",
    )
    start = F.when(x == "3", '"char_start": "0", ').otherwise('"char_start": 0, ')
    y = F.substring(F.md5("proposal_id"), 4, 1)
    owned = F.array(*[F.lit(k) for k in ("evidence_span", "page", "document", "provenance_validation", "source_sha256", "evidence_sha256", "source_chunk_id")])
    forged = F.when(x == "0", F.concat(F.lit('"'), F.element_at(owned, (F.ascii(y) % 7 + 1).cast("int")), F.when(y.isin("0", "1"), '": null, ').otherwise('": "forged", '))).otherwise("")
    fields = F.when(y == "5", "").otherwise(F.concat(F.lit('"fields": '), "fields", F.lit(", ")))
    payload = F.concat(F.lit("{"), start, forged, fields, F.expr("substring(_j, 2)"))
    p = _proposals(spark, d).withColumn("_j", F.to_json(s)).withColumn("payload", payload)
    return grounding.validate(grounding.begin(p)).groupBy(F.coalesce("detail", F.lit("valid")).alias("problem")).agg(F.count("*").alias("n"))


@query("resolve_references", """WITH p AS (SELECT DISTINCT ON (proposal_id) * FROM extraction_proposals) SELECT CASE WHEN x IN ('0', '1') THEN 'handle not minted' WHEN x IN ('2', '3') THEN 'handle and id disagree' WHEN x IN ('4', '5') THEN 'nothing to resolve' ELSE 'resolved' END AS outcome, count(*) AS n FROM (SELECT md5(proposal_id)[3] AS x FROM p) GROUP BY 1""")
def resolve_references(spark, d):
    x = F.substring(F.md5("proposal_id"), 3, 1)
    known = _fragments(spark, d).select(F.lit("w").alias("workstream"), F.concat(F.lit("F-"), "chunk_id").alias("handle"), "chunk_id")
    p = _proposals(spark, d).select("proposal_id", F.lit("w").alias("workstream"), norm_id("chunk_id").alias("_own"))
    handle = F.when(x.isin("0", "1"), "F7-MANGLED").when(x.isin("2", "3", "6", "7"), F.concat(F.lit("F-"), "_own"))
    given = F.when(x.isin("2", "3"), F.lit("00000000-0000-0000-0000-000000000000")).when(x.isin("6", "8", "9"), F.upper("_own"))
    now = F.when(~x.isin("4", "5"), F.col("_own"))
    p = p.withColumns({"chunk_handle": handle, "chunk_id": F.when(~x.isin("4", "5"), given), "current_id": now})
    return grounding.resolve(grounding.begin(p), known).groupBy(F.coalesce("detail", F.lit("resolved")).alias("outcome")).agg(F.count("*").alias("n"))


# --- entities and events --------------------------------------------------------------------------------------------


def _surfaces(spark: SparkSession, d: str) -> DataFrame:
    r = _records(spark, d)
    ordinal = F.struct("created", "record_id")
    one = lambda kind, c: r.filter(F.length(c) > 0).select(F.lit(kind).alias("entity_type"), F.col(c).alias("surface"), "record_id", ordinal.alias("ordinal"))
    return one("actor", "actor").unionByName(one("date", "event_date"))


@query("entities", f"""WITH r AS (SELECT DISTINCT ON (record_id) record_id, actor, event_date, created FROM enrichment_records),
s AS (SELECT 'actor' AS entity_type, actor AS surface, {_COLLAPSE('actor')} AS canonical, record_id, created FROM r WHERE actor <> '' UNION ALL SELECT 'date', event_date, {_STRIP('event_date')}, record_id, created FROM r WHERE event_date <> ''),
u AS (SELECT entity_type, canonical, surface, min({{'c': created, 'r': record_id}}) AS f FROM s GROUP BY ALL)
SELECT entity_type, canonical, min(f).r AS first_seen_record, coalesce(list(surface ORDER BY f) FILTER (surface <> canonical), []) AS aliases FROM u GROUP BY ALL""")
def entities_query(spark, d):
    return entities.resolve_or_create(_surfaces(spark, d)).select("entity_type", "canonical", "first_seen_record", "aliases")


_EDGES = f"e AS (SELECT DISTINCT {_N('record_id')} AS record_id, {_N('source_chunk_id')} AS chunk_id, {_N('r.entity_id')} AS entity_id FROM (SELECT record_id, source_chunk_id, unnest(entity_refs) AS r FROM enrichment_records) WHERE r.entity_id IS NOT NULL)"


@query("cross_context_entities", f"WITH {_EDGES} SELECT entity_id, count(DISTINCT chunk_id) AS chunks FROM e GROUP BY 1 HAVING count(DISTINCT chunk_id) >= 2")
def cross_context_entities(spark, d):
    return scoring.cross_context(entities.reference_edges(_records(spark, d)))


@query("entity_weights", f"WITH {_EDGES}, n AS (SELECT count(DISTINCT chunk_id) AS c FROM e) SELECT entity_id, count(DISTINCT chunk_id) AS weight, count(DISTINCT chunk_id) >= greatest(2, ceil(any_value(c) * 0.05)) AS is_theme FROM e, n GROUP BY 1")
def entity_weights(spark, d):
    return entities.weights(entities.reference_edges(_records(spark, d)))


@query("candidate_pairs", f"""WITH {_EDGES}, n AS (SELECT count(DISTINCT chunk_id) AS c FROM e), w AS (SELECT entity_id FROM e, n GROUP BY 1 HAVING count(DISTINCT chunk_id) < greatest(2, ceil(any_value(c) * 0.05))),
k AS (SELECT record_id, entity_id, row_number() OVER (PARTITION BY entity_id ORDER BY record_id) AS n FROM (SELECT DISTINCT record_id, entity_id FROM e WHERE entity_id IN (SELECT entity_id FROM w)))
SELECT a.record_id AS record_a, b.record_id AS record_b, count(*) AS shared FROM k a JOIN k b ON a.entity_id = b.entity_id AND b.n BETWEEN a.n + 1 AND a.n + 20 GROUP BY ALL""")
def candidate_pairs(spark, d):
    return entities.candidate_pairs(entities.reference_edges(_records(spark, d)))


_SHARED = f"""{_EDGES}, n AS (SELECT count(DISTINCT chunk_id) AS c FROM e), w AS (SELECT entity_id FROM e, n GROUP BY 1 HAVING count(DISTINCT chunk_id) < greatest(2, ceil(any_value(c) * 0.05))),
k AS (SELECT record_id, entity_id, row_number() OVER (PARTITION BY entity_id ORDER BY record_id) AS n FROM (SELECT DISTINCT record_id, entity_id FROM e WHERE entity_id IN (SELECT entity_id FROM w)))"""


@query("candidate_pairs_whole", f"""WITH {_SHARED}, {_FRAG}, r AS (SELECT DISTINCT {_N('record_id')} AS record_id, {_N('source_chunk_id')} AS chunk_id FROM enrichment_records), p AS (SELECT record_id, document, segment_index FROM r JOIN frag USING (chunk_id)),
u AS (SELECT a.record_id AS record_a, b.record_id AS record_b, 1 AS s, false AS near FROM k a JOIN k b ON a.entity_id = b.entity_id AND b.n BETWEEN a.n + 1 AND a.n + 20
 UNION ALL SELECT DISTINCT a.record_id, b.record_id, 0, true FROM p a JOIN p b ON a.document = b.document AND abs(a.segment_index - b.segment_index) <= 1 AND a.record_id < b.record_id)
SELECT record_a, record_b, sum(s)::BIGINT AS shared, bool_or(near) AS adjacent FROM u GROUP BY ALL""")
def candidate_pairs_whole(spark, d):
    return entities.candidates(_records(spark, d), _fragments(spark, d))


@query("candidate_fan_out", f"""WITH {_SHARED}, f AS (SELECT entity_id, count(*) AS records, count(*) * (count(*) - 1) // 2 AS pairs FROM k GROUP BY 1),
g AS (SELECT a.entity_id, count(*) AS kept FROM k a JOIN k b ON a.entity_id = b.entity_id AND b.n BETWEEN a.n + 1 AND a.n + 20 GROUP BY 1)
SELECT entity_id, records, pairs, pairs - coalesce(kept, 0) AS cut FROM f LEFT JOIN g USING (entity_id)""")
def candidate_fan_out(spark, d):
    return entities.fan_out_cut(entities.reference_edges(_records(spark, d)))


@query("cooccurrence", f"""WITH {_EDGES}, u AS (SELECT DISTINCT a.entity_id, b.entity_id AS other_id, a.record_id AS r, NULL AS c FROM e a JOIN e b ON a.record_id = b.record_id AND a.entity_id <> b.entity_id
 UNION ALL SELECT DISTINCT a.entity_id, b.entity_id, NULL, a.chunk_id FROM e a JOIN e b ON a.chunk_id = b.chunk_id AND a.entity_id <> b.entity_id)
SELECT entity_id, other_id, count(r) AS records, count(c) AS chunks FROM u GROUP BY ALL""")
def cooccurrence(spark, d):
    return entities.cooccurrence(entities.reference_edges(_records(spark, d)))


@query("current_records", f"SELECT DISTINCT {_N('record_id')} AS record_id FROM enrichment_records WHERE {_N('record_id')} NOT IN (SELECT {_N('supersedes')} FROM enrichment_records WHERE supersedes IS NOT NULL)")
def current_records(spark, d):
    return sinks.current(_records(spark, d)).select(norm_id("record_id").alias("record_id"))


@query("link_vocabulary", "SELECT regexp_replace(regexp_replace(lower(relation), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS relation, count(*) AS n FROM (SELECT DISTINCT link_id, relation FROM enrichment_links) GROUP BY 1")
def link_vocabulary(spark, d):
    return _links(spark, d).groupBy(text.normalize_type("relation").alias("relation")).agg(F.count("*").alias("n"))


_LINKED = f"""WITH {_FRAG}, r AS (SELECT DISTINCT {_N('record_id')} AS id, {_N('source_chunk_id')} AS c FROM enrichment_records), l AS (SELECT DISTINCT ON (link_id) * FROM enrichment_links),
j AS (SELECT l.*, x.id AS ia, y.id AS ib, f.text AS ta, g.text AS tb, (evidence::JSON->'$.a_span[0]')::INT AS s1, (evidence::JSON->'$.a_span[1]')::INT AS e1, (evidence::JSON->'$.b_span[0]')::INT AS s2, (evidence::JSON->'$.b_span[1]')::INT AS e2
 FROM l LEFT JOIN r x ON {_N('l.record_a')} = x.id LEFT JOIN r y ON {_N('l.record_b')} = y.id LEFT JOIN frag f ON x.c = f.chunk_id LEFT JOIN frag g ON y.c = g.chunk_id),
o AS (SELECT *, CASE WHEN ia IS NULL OR ib IS NULL THEN 'unknown_record' WHEN ta IS NULL OR tb IS NULL THEN 'fragment_not_found'
 WHEN NOT coalesce(s1 >= 0 AND s1 < e1 AND e1 <= length(ta), false) OR NOT coalesce(s2 >= 0 AND s2 < e2 AND e2 <= length(tb), false) THEN 'bad_offsets'
 WHEN {_STRIP('substring(ta, s1 + 1, e1 - s1)')} = '' OR {_STRIP('substring(tb, s2 + 1, e2 - s2)')} = '' THEN 'empty_span' END AS reason_code FROM j)
"""


def _linked(spark: SparkSession, d: str) -> DataFrame:
    return links.with_spans(links.with_ends(grounding.begin(_links(spark, d)), _records(spark, d), _fragments(spark, d)))


@query("links_validated", _LINKED + "SELECT link_id, reason_code FROM o")
def links_validated(spark, d):
    return _linked(spark, d).select("link_id", "reason_code")


@query("links_attested", _LINKED + "SELECT link_id, sha256(substring(ta, s1 + 1, e1 - s1)) AS a_evidence_sha256, sha256(substring(tb, s2 + 1, e2 - s2)) AS b_evidence_sha256, sha256(ta) AS a_source_sha256, sha256(tb) AS b_source_sha256 FROM o WHERE reason_code IS NULL")
def links_attested(spark, d):
    return links.hashes(_linked(spark, d)).filter("reason_code IS NULL").select("link_id", "a_evidence_sha256", "b_evidence_sha256", "a_source_sha256", "b_source_sha256")


@query("symmetric_links", f"SELECT least(a, b) AS first, greatest(a, b) AS second, count(*) AS n FROM (SELECT DISTINCT link_id, {_N('record_a')} AS a, {_N('record_b')} AS b FROM enrichment_links) GROUP BY ALL")
def symmetric_links(spark, d):
    return links.symmetric(_links(spark, d)).groupBy("first", "second").agg(F.count("*").alias("n"))


@query("event_members", f"""WITH RECURSIVE l AS (SELECT DISTINCT {_N('record_a')} AS a, {_N('record_b')} AS b FROM enrichment_links WHERE regexp_replace(lower(relation), '[\\s_-]+', '', 'g') = 'sameevent'),
w AS (SELECT a, b FROM l WHERE a <> b UNION SELECT b, a FROM l WHERE a <> b), reach(x, y) AS (SELECT a, a FROM w UNION SELECT r.x, w.b FROM reach r JOIN w ON r.y = w.a)
SELECT x AS record_id, min(y) AS component FROM reach GROUP BY 1""")
def event_members(spark, d):
    return events.components(events.ordered_links(_links(spark, d)).select("a", "b"))


@query("event_survivors")
def event_survivors(spark, d):
    return events.materialise(events.ordered_links(_links(spark, d)))[0]


@query("event_of_links")
def event_of_links(spark, d):
    return events.materialise(events.ordered_links(_links(spark, d)))[1]


@query("event_lookup", f"SELECT DISTINCT {_N('entity_id')} AS entity_id, {_N('m')} AS record_id FROM (SELECT entity_id, unnest(json_extract_string(metadata, '$.member_records[*]')) AS m FROM codex_entities WHERE entity_type = 'event' AND json_extract_string(metadata, '$.merged_into') IS NULL)")
def event_lookup(spark, d):
    """Live event of each member record: the containment as an explode, for equi joins."""
    e = table(spark, d, "codex_entities").filter("entity_type = 'event'").filter(F.get_json_object("metadata", "$.merged_into").isNull())
    return e.select(norm_id("entity_id").alias("entity_id"), F.explode(F.from_json("metadata", "member_records array<string>")["member_records"]).alias("m")).select("entity_id", norm_id("m").alias("record_id")).distinct()


@query("linked_walk", f"""WITH {_EDGES}, r AS (SELECT DISTINCT {_N('record_id')} AS record_id, {_N('source_chunk_id')} AS chunk_id, flagged, evidence_span FROM enrichment_records), s AS (SELECT record_id, chunk_id FROM r WHERE flagged),
p AS (SELECT {_N('record_a')} AS x, {_N('record_b')} AS y FROM enrichment_links UNION SELECT {_N('record_b')}, {_N('record_a')} FROM enrichment_links),
w0 AS (SELECT record_id FROM s UNION SELECT record_id FROM e WHERE entity_id IN (SELECT entity_id FROM e WHERE chunk_id IN (SELECT chunk_id FROM s))),
w1 AS (SELECT DISTINCT y AS record_id FROM p WHERE x IN (SELECT record_id FROM w0)), w2 AS (SELECT DISTINCT y AS record_id FROM p JOIN w1 ON x = w1.record_id JOIN r ON r.record_id = x),
u AS (SELECT record_id, 0 AS n FROM w0 UNION ALL SELECT record_id, 1 FROM w1 UNION ALL SELECT record_id, 2 FROM w2)
SELECT record_id, min(n)::INT AS steps, any_value(evidence_span) AS evidence_span FROM u JOIN r USING (record_id) GROUP BY 1""")
def linked_walk(spark, d):
    """From the flagged records and their chunks: records of the chunks' entities, then two links; each with its evidence."""
    r = _records(spark, d)
    start = r.filter("flagged").select("record_id", F.col("source_chunk_id").alias("chunk_id"))
    reached = entities.walk(start, entities.reference_edges(r), _links(spark, d), r, 2)
    spans = r.select(norm_id("record_id").alias("record_id"), "evidence_span").dropDuplicates(["record_id"])
    return reached.join(spans, "record_id").select("record_id", "steps", "evidence_span")


# --- scores ---------------------------------------------------------------------------------------------------------


def _attempts(spark: SparkSession, d: str) -> DataFrame:
    return grounded(spark, d).select("proposal_id", "chunk_id", F.col("char_start").isNotNull().alias("located"), "ok", "reason_code", "proposed_at", F.col("source_document").alias("document"))


@query("scorecard", _ATTEMPT_SQL + f""", {_EDGES}, s AS (SELECT DISTINCT ON (record_id) * FROM enrichment_records), t AS (SELECT count(*) AS proposals, count(*) FILTER (hit) AS located, count(*) FILTER (reason_code IS NULL) AS records, count(DISTINCT chunk_id) AS chunks_with_proposals, count(*) FILTER (hit) AS judged FROM a),
u AS (SELECT count(*) AS stored, count(*) FILTER (provenance_validation.verdict = 'grounded') AS grounded, count(*) FILTER (flagged) AS flagged FROM s), x AS (SELECT count(*) AS cross_context_entities FROM (SELECT entity_id FROM e GROUP BY 1 HAVING count(DISTINCT chunk_id) >= 2))
SELECT *, 0::BIGINT AS chunks_empty, proposals - located AS locate_miss, round_even(grounded / located, 4) AS pass_rate, round_even(stored / proposals, 4) AS yield_rate, round_even(chunks_with_proposals / 2.0, 2)::DOUBLE AS chunks_per_minute, round_even(stored / 2.0, 2)::DOUBLE AS records_per_minute, chunks_with_proposals AS chunks_seen, 120.0::DOUBLE AS wall_seconds FROM t, u, x""")
def scorecard(spark, d):
    r = _records(spark, d).withColumn("verdict", F.col("provenance_validation.verdict"))
    return scoring.scorecard(_attempts(spark, d), r, wall_s=120.0)


@query("chunk_counts", _ATTEMPT_SQL + "SELECT chunk_id, count(*) AS proposals, count(*) FILTER (reason_code IS NULL) AS grounded, count(*) FILTER (hit) AS located, count(*) FILTER (hit AND reason_code IS NOT NULL) AS bounced, count(*) FILTER (NOT hit) AS miss FROM a GROUP BY 1")
def chunk_counts(spark, d):
    return scoring.chunk_counts(_attempts(spark, d))


@query("running_accept_rate", _ATTEMPT_SQL + """, c AS (SELECT chunk_id, any_value(fdoc) AS document, count(*) FILTER (reason_code IS NULL) AS grounded FROM a WHERE fdoc IS NOT NULL GROUP BY 1)
SELECT document, chunk_id, count(*) OVER w AS done, (sum((grounded > 0)::INT) OVER w)::BIGINT AS accepted, round_even(sum((grounded > 0)::INT) OVER w / count(*) OVER w, 4) AS accept_rate FROM c WINDOW w AS (PARTITION BY document ORDER BY chunk_id ROWS UNBOUNDED PRECEDING)""")
def running_accept_rate(spark, d):
    a = _attempts(spark, d).filter("document IS NOT NULL")
    c = a.groupBy("document", "chunk_id").agg(F.count_if("ok").alias("grounded"))
    return scoring.running_accept_rate(c, ["chunk_id"], "document").select("document", "chunk_id", "done", "accepted", "accept_rate")


@query("faithfulness", "WITH s AS (SELECT DISTINCT ON (record_id) * FROM enrichment_records) SELECT count(*) AS total, count(*) FILTER (provenance_validation.verdict = 'grounded') AS grounded, count(*) FILTER (NOT coalesce(provenance_validation.verdict = 'grounded', false)) AS ungrounded, round_even(count(*) FILTER (provenance_validation.verdict = 'grounded') / count(*), 4) AS rate FROM s")
def faithfulness(spark, d):
    return scoring.faithfulness(_records(spark, d).select((F.col("provenance_validation.verdict") == "grounded").alias("grounded")))


@query("decisive_record", """WITH h AS (SELECT DISTINCT record_id, lower(concat_ws(' ', coalesce(evidence_span, ''), coalesce(fields, ''), coalesce(claim_relevance, ''), coalesce(actor, ''), coalesce(event_date, ''))) AS hay FROM enrichment_records WHERE provenance_validation.verdict = 'grounded')
SELECT record_id, CASE WHEN contains(hay, 'reversed') THEN 'reversed' ELSE 'reversal' END AS term, CASE WHEN contains(hay, 'approval') THEN 'approval' ELSE 'payment' END AS condition FROM h WHERE regexp_matches(hay, '\\b[a-z]\\. [a-z]+') AND (contains(hay, 'reversed') OR contains(hay, 'reversal')) AND (contains(hay, 'approval') OR contains(hay, 'payment')) ORDER BY record_id LIMIT 1""")
def decisive_record(spark, d):
    return scoring.decisive(_records(spark, d), F.lit(True), r"\b[a-z]\. [a-z]+", ["reversed", "reversal"], ["approval", "payment"])


@query("plateau", """WITH t AS (SELECT doc_id AS chunk_id, unnest(range(1, 6)) AS n FROM documents), c AS (SELECT chunk_id, n, ((chunk_id * 37 + n * 17) % 100) / 100.0::DOUBLE AS c FROM t), b AS (SELECT *, max(c) OVER (PARTITION BY chunk_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM c)
SELECT chunk_id, coalesce(min(CASE WHEN n > 1 AND c < best + 0.05::DOUBLE THEN n END), 0)::INT AS stopped_at, max(c)::DOUBLE AS best_confidence, count(*) AS tries FROM b GROUP BY 1""")
def plateau(spark, d):
    t = table(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("n"))
    p = passes.plateau(t.withColumn("confidence", ((F.col("chunk_id") * 37 + F.col("n") * 17) % 100) / F.lit(100.0)))
    return p.withColumn("stopped_at", F.coalesce("stopped_at", F.lit(0)))


@query("consolidated_types", "SELECT DISTINCT record_type AS term, CASE record_type WHEN 'benefit_payment' THEN 'payment' WHEN 'document_received' THEN 'receipt' ELSE record_type END AS canonical FROM enrichment_records WHERE record_type IS NOT NULL")
def consolidated_types(spark, d):
    vocab = table(spark, d, "enrichment_records").select(F.col("record_type").alias("term")).dropna().distinct()
    return passes.consolidate(vocab, spark.createDataFrame([("benefit_payment", "Payment"), ("document_received", "receipt")], "raw string, canonical string"))


#: The number that a uuid's 32 hex digits are, modulo 100: queries of the rank are the rows where it is 0.
_MOD_SQL = "(76 * (('0x' || substr(h, 1, 2))::BIGINT % 100) + 76 * (('0x' || substr(h, 3, 15))::BIGINT % 100) + ('0x' || substr(h, 18, 15))::BIGINT % 100) % 100 = 0"


@query("meaning_rank", f"""WITH m AS (SELECT DISTINCT ON (id) {_N('meaning_id')} AS id, embedding::DOUBLE[] AS v FROM enrichment_meaning WHERE len(embedding) > 0 AND list_max(embedding) - list_min(embedding) + abs(list_max(embedding)) > 0), h AS (SELECT id, v, replace(id, '-', '') AS h FROM m),
c AS (SELECT q.id AS query, m.id, round(list_cosine_similarity(m.v, q.v), 6) AS cosine FROM m JOIN (SELECT id, v FROM h WHERE {_MOD_SQL}) q ON len(m.v) = len(q.v)), n AS (SELECT *, (row_number() OVER (PARTITION BY query ORDER BY cosine DESC, id))::INT AS rank FROM c) SELECT * FROM n WHERE rank <= 10""")
def meaning_rank(spark, d):
    """The ten meanings nearest to each whose id is divisible by 100, with their rank."""
    m = table(spark, d, "enrichment_meaning").select(norm_id("meaning_id").alias("id"), "embedding")
    digits = F.replace("id", F.lit("-"), F.lit(""))
    part = lambda at, n: F.conv(F.substring(digits, at, n), 16, 10).cast("bigint") % 100
    return ranking.rank_by_cosine(m.filter((76 * part(1, 2) + 76 * part(3, 15) + part(18, 15)) % 100 == 0), m, "id", "embedding", 10)


@query("vector_rank", "WITH c AS (SELECT q.vec_id AS query, e.vec_id AS id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS cosine FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0), n AS (SELECT *, (row_number() OVER (PARTITION BY query ORDER BY cosine DESC, id))::INT AS rank FROM c) SELECT * FROM n WHERE rank <= 10")
def vector_rank(spark, d):
    """The same over the table of embeddings."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return ranking.rank_by_cosine(e.filter("vec_id % 100 = 0"), e, "vec_id", "embedding", 10)


@query("export_check", f"WITH {_FRAG}, r AS (SELECT DISTINCT ON (record_id) * FROM enrichment_records) SELECT record_id, provenance_validation.verdict AS verdict, CASE WHEN substring(coalesce(f.text, ''), char_start + 1, char_end - char_start) = evidence_span THEN 'OK' ELSE 'MISMATCH!' END AS slice_check FROM r LEFT JOIN frag f ON {_N('r.source_chunk_id')} = f.chunk_id")
def export_check(spark, d):
    return sinks.export_rows(_records(spark, d), _fragments(spark, d)).select("record_id", "verdict", "slice_check")


@query("table_counts", "SELECT 'enrichment_records' AS name, count(*) AS n FROM enrichment_records UNION ALL SELECT 'codex_entities', count(*) FROM codex_entities UNION ALL SELECT 'enrichment_links', count(*) FROM enrichment_links")
def table_counts(spark, d):
    one = lambda n: table(spark, d, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n")
    return one("enrichment_records").unionByName(one("codex_entities")).unionByName(one("enrichment_links"))


@query("heartbeat", "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS \"end\", count(*) AS attempts, count(*) FILTER (value > 50) AS accepted FROM events GROUP BY 1")
def heartbeat(spark, d):
    from groundmill.streaming.attempts import heartbeat as beat

    e = table(spark, d, "events").select(F.col("ts").alias("at"), (F.col("value") > 50).alias("ok"))
    return beat(e, "1 hour")


@query("entity_refs_built", f"""WITH r AS (SELECT DISTINCT ON (record_id) record_id, actor, event_date FROM enrichment_records), u AS (
SELECT record_id, 0 AS n, 'actor' AS role, 'actor' AS entity_type, {_COLLAPSE('actor')} AS canonical FROM r WHERE actor <> '' UNION ALL SELECT record_id, 1, 'event_date', 'date', {_STRIP('event_date')} FROM r WHERE event_date <> '')
SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY n) - 1 AS place, role, entity_type, canonical, md5(concat_ws(chr(31), entity_type, canonical)) AS id FROM u""")
def entity_refs_built(spark, d):
    """References that every record would be written with: its actor, then its date."""
    who, when = text.normalize_actor("actor"), text.strip("event_date")
    refs = grounding.entity_refs(F.col("actor"), entities.content_id(F.lit("actor"), who), F.col("event_date"), entities.content_id(F.lit("date"), when))
    e = _records(spark, d).select("record_id", F.posexplode(refs).alias("place", "r"))
    return e.select("record_id", F.col("place").cast("bigint").alias("place"), "r.role", "r.entity_type", "r.canonical", F.replace("r.entity_id", F.lit("-"), F.lit("")).alias("id"))


@query("records_by_chunk", f"SELECT {_N('source_chunk_id')} AS chunk_id, count(*) AS records, string_agg({_N('record_id')}, ' ' ORDER BY char_start, {_N('record_id')}) AS ids FROM (SELECT DISTINCT ON (record_id) * FROM enrichment_records) WHERE source_chunk_id IS NOT NULL GROUP BY 1")
def records_by_chunk(spark, d):
    """Records of each chunk in order of place."""
    r = entities.by_chunk(_records(spark, d), [norm_id("record_id").alias("record_id")])
    return r.select("chunk_id", F.size("records").cast("bigint").alias("records"), F.array_join(F.transform("records", lambda x: x["record_id"]), " ").alias("ids"))


@query("record_lookup", f"WITH r AS (SELECT DISTINCT ON ({_N('record_id')}) {_N('record_id')} AS id, record_type FROM enrichment_records) SELECT l.link_id, r.id AS record_id, r.record_type FROM (SELECT DISTINCT link_id, record_a FROM enrichment_links) l LEFT JOIN r ON {_N('l.record_a')} = r.id")
def record_lookup(spark, d):
    """The first record of every link, by its id in whatever spelling."""
    got = sinks.get_record(_records(spark, d).select("record_id", "record_type"), _links(spark, d).select("link_id", "record_a"), "record_a")
    return got.select("link_id", norm_id("r_record_id").alias("record_id"), F.col("r_record_type").alias("record_type"))


@query("seed_relations", "SELECT norm AS relation, norm IN ('precedes', 'follows', 'causes', 'results_from', 'corroborates', 'contradicts', 'elaborates', 'same_event', 'references') AS seed, count(*) AS n FROM (SELECT DISTINCT link_id, regexp_replace(regexp_replace(lower(relation), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS norm FROM enrichment_links) GROUP BY ALL")
def seed_relations(spark, d):
    """Relations in use and whether they are of the vocabulary known in advance."""
    return _links(spark, d).groupBy(text.normalize_type("relation").alias("relation"), links.is_seed(F.col("relation")).alias("seed")).agg(F.count("*").alias("n"))


@query("relation_terms", "SELECT DISTINCT regexp_replace(regexp_replace(lower(relation), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS term FROM enrichment_links")
def relation_terms(spark, d):
    """The vocabulary of relations, by chunk lists as a pass gives them."""
    return passes.vocabulary(_links(spark, d).select(F.array(text.normalize_type("relation")).alias("terms")), "terms")


@query("claim_haystack", "SELECT DISTINCT record_id, lower(concat_ws(' ', coalesce(evidence_span, ''), coalesce(fields, ''), coalesce(claim_relevance, ''), coalesce(actor, ''), coalesce(event_date, ''))) AS hay FROM enrichment_records")
def claim_haystack(spark, d):
    return _records(spark, d).select("record_id", text.haystack(*[F.col(c) for c in ("evidence_span", "fields", "claim_relevance", "actor", "event_date")]).alias("hay"))


@query("meaning_substance", r"""WITH m AS (SELECT DISTINCT ON (meaning_id) meaning_id, claim_meaning AS t FROM enrichment_meaning)
SELECT meaning_id, coalesce(regexp_matches(t, '(?i)\b(?:this|the) (?:passage|document|chunk|text|excerpt|section|page) (?:is|describes?|discusses?|mentions?|contains?|provides?|outlines?|states?)\b'), false) AS of_itself,
len(list_distinct(regexp_extract_all(coalesce(t, ''), '\b(?:[A-Z][0-9A-Za-z_''’-]+(?: [A-Z][0-9A-Za-z_''’-]+)+|\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{2,4})')))::INT AS hooks FROM m""")
def meaning_substance(spark, d):
    """Meanings that speak of themselves, and how many names and dates each has that no entity is known for."""
    m = table(spark, d, "enrichment_meaning").dropDuplicates(["meaning_id"])
    return m.select("meaning_id", substance.speaks_of_itself(F.col("claim_meaning")).alias("of_itself"), F.size(substance.unresolved_hooks(F.col("claim_meaning"), F.lit(None).cast("array<string>"))).alias("hooks"))


@query("gold_note", """WITH h AS (SELECT DISTINCT record_id, lower(concat_ws(' ', coalesce(evidence_span, ''), coalesce(fields, ''), coalesce(claim_relevance, ''), coalesce(actor, ''), coalesce(event_date, ''))) AS hay FROM enrichment_records
 WHERE provenance_validation.verdict = 'grounded' AND lower(source_chunk_id) = (SELECT min(lower(source_chunk_id)) FROM enrichment_records WHERE provenance_validation.verdict = 'grounded' AND lower(evidence_span) LIKE '%reversed%'))
SELECT coalesce(bool_or(contains(hay, 'reversed the earlier')), false) AS smoking_gun, min(CASE WHEN contains(hay, 'reversed the earlier') AND contains(hay, 'approval') THEN record_id END) AS record_id FROM h""")
def gold_note(spark, d):
    """The decisive record of one chunk: the first chunk whose records tell of a reversal stands for the gold note."""
    r = _records(spark, d)
    fine = r.filter((F.col("provenance_validation.verdict") == "grounded") & F.lower("evidence_span").contains("reversed"))
    gold = fine.agg(F.min(F.lower("source_chunk_id")).alias("_gold"))  # one row
    here = r.crossJoin(F.broadcast(gold)).filter(F.lower("source_chunk_id") == F.col("_gold")).withColumn("source_chunk_id", F.lit("gold"))
    found = scoring.smoking_gun(here, "gold", "reversed", ("reversed the earlier",), ("approval",))
    return found.select("smoking_gun", F.col("smoking_gun_detail.record_id").alias("record_id"))


QUERIES, ORACLES = Q, SQL
