"""Markdown of collected rows: one scorecard row for each run, and the review of chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from groundmill.sources import sinks

COLUMNS = ["proposals", "located", "stored", "grounded", "flagged", "pass_rate", "yield_rate", "chunks_with_proposals", "chunks_empty", "cross_context_entities", "chunks_per_minute", "records_per_minute"]


def _cell(value) -> str:
    return "" if value is None else str(value).replace("|", "\\|").replace("\n", " ")


def scorecard_table(cards: dict[str, DataFrame]) -> str:
    """A table with a row for each named scorecard (DataFrames of one row)."""
    head = ["run", *COLUMNS]
    lines = ["| " + " | ".join(head) + " |", "|" + "---|" * len(head)]
    for name, df in cards.items():
        row = df.select(*[c for c in COLUMNS if c in df.columns]).limit(1).collect()[0].asDict()
        lines.append("| " + " | ".join(_cell(v) for v in [name, *(row.get(c) for c in COLUMNS)]) + " |")
    return "\n".join(lines) + "\n"


CARD = ["label", "candidate_model", "proposals", "located", "locate_miss", "stored", "grounded", "flagged", "pass_rate", "yield_rate", "cross_context_entities", "smoking_gun", "chunks_seen", "chunks_missing", "chunks_with_proposals", "chunks_empty", "chunks_per_minute", "records_per_minute", "wall_seconds", "extract_errors"]


def runs_report(spark: SparkSession, pattern: str) -> str:
    """All scorecards that the pattern names: a row for each run, then each in detail."""
    cards = [r.asDict() for r in sinks.scorecards(spark, pattern, CARD).orderBy("label").collect()]  # a row for each run
    out = ["# Runs", "", "| run | model | pass rate | coverage | cross-context | decisive note | pace |", "|---|---|---|---|---|---|---|"]
    for c in cards:
        out.append(f"| {_cell(c['label'])} | {_cell(c['candidate_model'])} | {c['pass_rate']:.0%} ({c['grounded']}/{c['located']}) | {c['chunks_with_proposals']}/{c['chunks_seen']} | {c['cross_context_entities']} | {'yes' if c['smoking_gun'] else 'no'} | {c['chunks_per_minute']:.1f} chunks, {c['records_per_minute']:.1f} records a minute |")
    for c in cards:
        out += ["", f"### {_cell(c['label'])}", *(f"- {k}: {_cell(c[k])}" for k in CARD[1:])]
    return "\n".join(out if cards else [*out, "| none yet | | | | | | |"]) + "\n"


def review(reviewed: DataFrame, vocabulary: DataFrame | None = None, chunks: int | None = None, terms: int = 40) -> str:
    """A section for every chunk of ``passes.review``, or the first ``chunks`` and how many are left out, and the first
    terms of the vocabulary, for reading by eye."""
    out = ["# Review"]
    if vocabulary is not None:
        out.append("Terms: " + ", ".join(_cell(r["term"]) for r in vocabulary.orderBy("term").limit(terms).collect()))
    ordered = reviewed.orderBy("chunk_id")
    for r in (ordered if chunks is None else ordered.limit(chunks)).toLocalIterator():
        out.append(f"\n## {r['chunk_id']}")
        out += [f"- {k}: {_cell(v.asDict() if hasattr(v, 'asDict') else v)}" for k, v in r.asDict().items() if k != "chunk_id"]
    if chunks is not None and (left := reviewed.count() - chunks) > 0:
        out.append(f"\n{left} more chunks are not shown.")
    return "\n".join(out) + "\n"
