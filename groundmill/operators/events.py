"""Event clusters of accepted same_event links, in the order of the links.

Membership does not depend on the order, the surviving event does. Links are first given the id of their component
(smallest record, by label propagation with pointer jumping, checkpointed every round); each component is then
folded in order. A component's links are the unit of the fold: its state is inherently sequential."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.common import durable, norm_id

MAX_ROUNDS = 60
EVENTS = "event_id string, canonical string, first_seen_record string, member_records array<string>, merged_into string, flagged boolean"
STEPS = "link_id string, event_entity string"


def is_same_event(relation: str = "relation"):
    return F.regexp_replace(F.lower(relation), r"(?U)[\s_-]+", "") == "sameevent"


def components(pairs: DataFrame) -> DataFrame:
    """(record_id, component) of pairs (a, b): every round a record takes the smallest label among itself and its
    neighbours, the smallest that any record of its old label found, and that of its new label. So labels merge as
    trees do, in some log n rounds."""
    edges = durable(pairs.filter("a <> b").select("a", "b").union(pairs.filter("a <> b").select("b", "a")).distinct())
    label = durable(edges.groupBy(F.col("a").alias("record_id")).agg(F.least(F.min("b"), F.col("record_id")).alias("component")))
    for _ in range(MAX_ROUNDS):
        near = edges.join(label.withColumnsRenamed({"record_id": "b", "component": "c"}), "b").groupBy("a").agg(F.min("c").alias("c"))
        best = durable(label.join(near, F.col("record_id") == F.col("a")).select("record_id", F.col("component").alias("old"), F.least("component", "c").alias("m")))
        # of a root both what it found itself and what the records with its label found: doubling and merging
        hook = best.select(F.col("old").alias("root"), "m").unionByName(best.select(F.col("record_id").alias("root"), "m")).groupBy("root").agg(F.min("m").alias("to"))
        mine, next_ = hook.withColumnsRenamed({"root": "r1", "to": "t1"}), hook.withColumnsRenamed({"root": "r2", "to": "t2"})
        joined = best.join(mine, F.col("old") == F.col("r1")).join(next_, F.col("m") == F.col("r2"), "left")
        new = durable(joined.select("record_id", "old", F.least("m", "t1", F.coalesce("t2", "m")).alias("component")))
        moved = new.filter("component <> old").limit(1).count()
        label = new.drop("old")
        if not moved:
            return label
    raise RuntimeError(f"labels still move after {MAX_ROUNDS} rounds")


def fold(links: pd.DataFrame) -> tuple[list[tuple], list[tuple]]:
    """Events and the event of each link, for the links of a component in order."""
    event_of: dict[str, int] = {}
    events: list[dict] = []
    steps = []
    for link, a, b in links[["link_id", "a", "b"]].itertuples(index=False):
        x, y = event_of.get(a), event_of.get(b)
        if x is None and y is None:
            low = min(a, b)
            events.append({"id": f"event:{link}", "canonical": f"event:{low}", "first": a, "members": {a, b}, "into": None})
            at = len(events) - 1
        elif x is None or y is None or x == y:
            at = y if x is None else x
            events[at]["members"] |= {a, b}
        else:
            at = x
            gone = events[y]
            events[x]["members"] |= gone["members"]
            for r in gone["members"]:
                event_of[r] = x
            gone["members"], gone["into"] = set(), events[x]["id"]
        event_of[a] = event_of[b] = at
        steps.append((link, events[at]["id"]))
    return [(e["id"], e["canonical"], e["first"], sorted(e["members"]), e["into"], e["into"] is not None) for e in events], steps


def ordered_links(links: DataFrame) -> DataFrame:
    """Accepted same_event links with normal ids and their order: by time, then by id."""
    return links.filter(is_same_event()).select(norm_id("link_id").alias("link_id"), norm_id("record_a").alias("a"), norm_id("record_b").alias("b"), "created").filter("a <> b").dropDuplicates(["link_id"])


def materialise(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, event of each link) of ``links`` (link_id, a, b, created)."""
    comp = components(links.select("a", "b"))
    of = durable(links.join(comp, F.col("a") == F.col("record_id")).select("component", "link_id", "a", "b", "created"))

    columns = [x.split()[0] for x in EVENTS.split(", ")]

    def run(g: pd.DataFrame) -> pd.DataFrame:
        found, steps = fold(g.sort_values(["created", "link_id"]))
        return pd.concat([pd.DataFrame(found, columns=columns), pd.DataFrame(steps, columns=["link_id", "event_entity"])], ignore_index=True).astype(object).where(lambda x: x.notna(), None)

    both = durable(of.groupBy("component").applyInPandas(run, f"{EVENTS}, {STEPS}"))
    return both.filter("event_id IS NOT NULL").select(*columns), both.filter("link_id IS NOT NULL").select("link_id", "event_entity")
