"""Mixing sources to target weights by Sainte-Laguë apportionment.

The documents of a source stand in a seeded order, cut into shards, and a shard's run of tokens into blocks of equal
tokens. Seats (blocks of the mix) go to sources by the highest quotients share / (2 * seats + 1), a source leaving when its
blocks are used as often as ``max_repeats`` allows; a source's seats go to its shards in the same way, giving integer quotas.
A shard gives its quota of blocks as an arc of its ring from a seeded place on, whole rounds first; a document goes with the
block in which it begins. So a shard's tokens differ from its quota by the documents at the arc's two ends at most.

Defined cases: sources without target, null sources and documents without tokens are left out (share 0 in the
report); a target without documents reaches 0 and its share goes to the others in proportion; repeated
documents are what they are; an empty table gives a report of zeros and an empty mix.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundmill.common import durable

#: Tokens of a block, and blocks a shard should hold.
BLOCK_TOKENS = 256
BLOCKS_PER_SHARD = 4096
#: Shards whose quotas one task works out; seats go to such groups first.
SHARDS_PER_GROUP = 50_000
#: The table of targets is a small dimension: more rows are refused, not collected.
MAX_TARGETS = 100_000


def sainte_lague(weights: np.ndarray, caps: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients weight / (2 * seats + 1), none above its cap; ties go to the first.

    The quotient of the last seat is found by bisection: above it every party has a number of seats at once. What is left
    are seats of equal quotients, one for a party at most. Time grows with the parties, not with the seats."""
    w, caps = np.maximum(np.asarray(weights, float), 0), np.asarray(caps, np.int64)
    caps = np.where(w > 0, caps, 0)
    seats = int(min(seats, caps.sum()))
    got = np.zeros(len(w), np.int64)
    if seats <= 0:
        return got

    def at(q: float) -> np.ndarray:
        """Seats with quotients of ``q`` or more."""
        n = np.minimum(np.floor((w / q + 1) / 2), caps).astype(np.int64)
        n -= (n > 0) & (w / np.maximum(2 * n - 1, 1) < q)  # where the division was rounded over an edge
        return n + ((n < caps) & (w / (2 * n + 1) >= q))

    low, high = w[w > 0].min() / (2.0 * caps.max() + 1), np.nextafter(w.max(), np.inf)
    while True:
        mid = low + (high - low) / 2
        if not low < mid < high:
            break
        low, high = (mid, high) if at(mid).sum() >= seats else (low, mid)
    got = at(high)
    left = seats - int(got.sum())
    if left > 0:
        next_ = np.where(got < caps, w / (2 * got + 1), -1.0)
        got[np.argsort(-next_, kind="stable")[:left]] += 1
    return got


def mix(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(documents with ``copies``, report of shares). ``sized`` has doc_id, source, n_tokens.

    ``total_tokens``: the size of the mix; by default the largest at which every source with documents
    can still reach its share within ``max_repeats``."""
    rows = targets.select("source", F.col("target_share").cast("double"), F.col("max_repeats").cast("bigint")).dropna(subset=["source"]).dropDuplicates(["source"]).limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    names = sorted(r["source"] for r in rows if (r["target_share"] or 0) > 0 and (r["max_repeats"] or 0) > 0)
    share, repeats = {r["source"]: r["target_share"] for r in rows}, {r["source"]: r["max_repeats"] for r in rows}
    wanted = durable(sized.filter((F.col("n_tokens") > 0) & F.col("source").isin(names)).select("doc_id", "source", F.col("n_tokens").cast("bigint")))
    stock = {r["source"]: r["t"] for r in wanted.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}  # one row for each target
    have = [s for s in names if s in stock]
    scale = sum(share[s] for s in have) or 1.0
    if total_tokens is None:
        total_tokens = int(min((stock[s] * repeats[s] / (share[s] / scale) for s in have), default=0))
    shards = {s: max(1, -(-stock[s] // (block_tokens * BLOCKS_PER_SHARD))) for s in have}
    groups = {s: max(1, -(-shards[s] // SHARDS_PER_GROUP)) for s in have}
    of = lambda d: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in d.items() for x in kv]), F.col("source")), F.lit(1)) if d else F.lit(1)
    placed = wanted.withColumns({"shard": F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), of(shards)).cast("int"), "_order": F.xxhash64(F.lit(seed), "doc_id")})
    before = Window.partitionBy("source", "shard").orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)  # a shard is bounded
    placed = durable(placed.withColumn("block", F.floor(F.coalesce(F.sum("n_tokens").over(before), F.lit(0)) / block_tokens)).drop("_order"))
    per_shard = durable(placed.groupBy("source", "shard").agg(F.sum("n_tokens").alias("held")).withColumn("part", F.pmod("shard", of(groups)).cast("int")))
    parts = per_shard.groupBy("source", "part").agg(F.sum("held").alias("held"), F.sum(F.ceil(F.col("held") / block_tokens)).alias("blocks")).orderBy("source", "part").collect()  # a row for SHARDS_PER_GROUP shards
    blocks = {s: sum(p["blocks"] for p in parts if p["source"] == s) for s in have}
    seats = sainte_lague(np.array([share[s] for s in have]), np.array([blocks[s] * repeats[s] for s in have]), round(total_tokens / block_tokens)) if have else []
    quota: dict[tuple[str, int], int] = {}
    for s, n in zip(have, seats, strict=True):
        mine = [p for p in parts if p["source"] == s]
        given = sainte_lague(np.array([p["held"] for p in mine]), np.array([p["blocks"] * repeats[s] for p in mine]), int(n))
        quota |= {(s, p["part"]): int(g) for p, g in zip(mine, given, strict=True)}

    def to_shards(of: pd.DataFrame) -> pd.DataFrame:
        s = of["source"].iloc[0]
        of = of.sort_values("shard", ignore_index=True)
        held = of["held"].to_numpy(np.int64)
        blocks = -(-held // block_tokens)
        return pd.DataFrame({"source": of["source"], "shard": of["shard"], "quota": sainte_lague(held, blocks * repeats[s], quota[s, int(of["part"].iloc[0])]), "blocks": blocks})

    quotas = per_shard.groupBy("source", "part").applyInPandas(to_shards, "source string, shard int, quota bigint, blocks bigint")
    start = F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.col("blocks"))
    whole = F.floor(F.col("quota") / F.col("blocks"))
    in_arc = F.pmod(F.col("block") - start, F.col("blocks")) < F.col("quota") - whole * F.col("blocks")
    chosen = placed.join(quotas, ["source", "shard"]).withColumn("copies", (whole + in_arc.cast("int")).cast("int")).filter("copies > 0")
    mixed = durable(chosen.select("doc_id", "source", "n_tokens", "copies"))
    return mixed, shares(mixed, sized, targets)


def shares(mixed: DataFrame, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and reached shares by source, sources without target included."""
    stock = sized.groupBy("source").agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("available_tokens"))
    used = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.count("*").alias("mixed_documents"), F.max("copies").alias("most_copies"))
    goal = targets.dropDuplicates(["source"]).select("source", "target_share", "max_repeats")
    whole = mixed.agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("_all"))
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    joined = stock.withColumn("k", F.coalesce("source", F.lit("\0"))).join(goal.withColumn("k", F.coalesce("source", F.lit("\0"))).withColumnRenamed("source", "s2"), "k", "full").join(used.withColumnsRenamed({"source": "s3"}), F.col("k") == F.col("s3"), "left").crossJoin(F.broadcast(whole))
    return joined.select(
        F.coalesce("source", "s2").alias("source"), n("target_share"), n("max_repeats"), n("documents"), n("available_tokens"), n("mixed_documents"), n("mixed_tokens"), n("most_copies"),
        F.round(F.coalesce(F.col("mixed_tokens") / F.col("_all"), F.lit(0.0)), 6).alias("actual_share"),
    )
