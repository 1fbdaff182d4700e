"""The k most similar vectors of every vector: inverted lists scanned by an adaptive dimension scan.

Vectors are made unit length, rotated by a fixed random rotation and put into lists around centres fitted on
a bounded sample. Every vector probes the lists of its nearest centres. In a list the dimensions are read in
column blocks; after each block a hypothesis test on the partial distance abandons the candidates that
are too far, and only survivors are measured in full, in double precision on the vectors as given.

Equal vectors form one class, searched once with at most k + 1 of its ids (no more can count), so a group of
copies never meets itself. A list, or its probes, beyond a block size is split over tasks.

Defined cases: null, empty and zero vectors, vectors with null or non-finite numbers and vectors of another length
than ``dims`` (by default the most frequent) take no part; repeated rows of one id are one; ties go to the
smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundmill.common import durable

#: Vectors the centres are fitted on: for each list, and in all at most. Vectors aimed at in a list, until the lists
#: would be more than the square root of PROBES times the vectors: from there both grow with the root, so the scan's work
#: grows as the power 1.5 and what is broadcast (the centres) as the power 0.5.
SAMPLE_PER_LIST, SAMPLE_MOST = 40, 400_000
LIST_SIZE = 250
#: Lists up to which the centres are fitted at once; more are fitted in two levels.
FLAT_LISTS = 1024
PROBES = 8
#: Rows of a list, and probes, that one task holds.
BLOCK_ROWS = 8192
COLUMN_BLOCK = 16
#: Significance of the test: a candidate goes when its scaled partial distance exceeds (1 + EPS / sqrt(dims read)) times the bound.
EPS = 2.1
SEED = 11


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _means(x: np.ndarray, lists: int, rounds: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: (centres, nearest centre of each vector)."""
    c = x[rng.choice(len(x), lists, replace=False)]
    near = np.zeros(len(x), np.int64)
    for r in range(rounds + 1):
        near = np.concatenate([(x[i : i + 8192] @ c.T).argmax(1) for i in range(0, len(x), 8192)])
        if r < rounds:
            total = np.zeros_like(c)
            np.add.at(total, near, x)
            size = np.linalg.norm(total, axis=1, keepdims=True)
            c = np.where(size > 1e-12, total / np.maximum(size, 1e-12), c)
    return c, near


def fit_centres(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = SEED, flat: int = FLAT_LISTS) -> np.ndarray:
    """Centres fitted on the sample; many lists in two levels, each coarse cell with fine centres by its part of the sample."""
    rng = np.random.default_rng(seed)
    x = sample.astype(np.float32)
    if lists <= flat:
        return _means(x, lists, rounds, rng)[0]
    coarse = math.isqrt(lists)
    _, near = _means(x, coarse, rounds, rng)
    size = np.bincount(near, minlength=coarse)
    share = np.minimum(np.maximum(1, np.floor(size / len(x) * lists).astype(int)), size)
    return np.concatenate([_means(x[near == c], n, rounds, rng)[0] for c, n in enumerate(share) if n])


def lists_for(n: int, probes: int) -> int:
    return max(1, min(n // LIST_SIZE, math.isqrt(max(1, probes) * n)))


def scan(q: np.ndarray, x: np.ndarray, least: float, rot: np.ndarray, k: int | None = None, block: int = COLUMN_BLOCK, eps: float | None = EPS, step: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, cosine rounded to 6) of the pairs that survive and reach ``least``.

    The bound is the distance of ``least``. Where many candidates pass the first block, each query with ``k`` gets a bound of its
    own: of the candidates nearest by that block the k + 1 best are measured, and what is farther than the last of them
    cannot count. ``eps`` None abandons only what is beyond the bound already, which is exact."""
    d = q.shape[1]
    qr, xr = (q @ rot).astype(np.float32), (x @ rot).astype(np.float32)
    widest = 2 - 2 * least + 2e-6
    slack = lambda seen: 1e-4 if eps is None or seen >= d else 0.0
    scale = lambda seen: 1.0 if eps is None or seen >= d else (1 + eps / math.sqrt(seen)) ** 2 * seen / d
    out = []
    for s in range(0, len(q), step):
        part = qr[s : s + step]
        first = min(block, d)
        dist = (part[:, :first] ** 2).sum(1)[:, None] + (xr[:, :first] ** 2).sum(1)[None] - 2 * part[:, :first] @ xr[:, :first].T
        bound = np.full(len(part), widest, np.float32)
        passed = dist <= widest * scale(first) + slack(first)
        if k is not None and passed.mean() > 0.1 and len(x) > 8 * (k + 1):
            near = np.argpartition(dist, 4 * (k + 1), axis=1)[:, : 4 * (k + 1)]
            exact = np.einsum("id,ijd->ij", q[s : s + step], x[near])
            kth = np.partition(exact, -(k + 1), axis=1)[:, -(k + 1)]
            bound = np.minimum(bound, (2 - 2 * kth + 4e-6).astype(np.float32))
            passed = dist <= (bound * scale(first) + slack(first))[:, None]
        i, j = np.nonzero(passed)
        got = dist[i, j]
        for at in range(first, d, block):
            for p in range(0, len(i), 200_000):
                got[p : p + 200_000] += ((part[i[p : p + 200_000], at : at + block] - xr[j[p : p + 200_000], at : at + block]) ** 2).sum(1)
            keep = got <= bound[i] * scale(min(at + block, d)) + slack(min(at + block, d))
            i, j, got = i[keep], j[keep], got[keep]
        for p in range(0, len(i), 100_000):
            a, b = i[p : p + 100_000] + s, j[p : p + 100_000]
            cos = np.round(np.einsum("ij,ij->i", q[a], x[b]), 6)
            ok = cos >= least
            out.append((a[ok], b[ok], cos[ok]))
    if not out:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(z) for z in zip(*out, strict=True))  # type: ignore[return-value]


def _stack(column: pd.Series) -> np.ndarray:
    """Vectors of packed little-endian floats, as a matrix of doubles."""
    return np.frombuffer(b"".join(column), "<f4").reshape(len(column), -1).astype(np.float64)


def _best(cid: np.ndarray, ids: list[np.ndarray], a: np.ndarray, b: np.ndarray, cos: np.ndarray, k: int) -> pd.DataFrame:
    """The k + 1 best ids of each query class, by cosine and id."""
    n = np.fromiter(map(len, ids), int, len(ids))[b]
    rows = pd.DataFrame({"cid": cid[np.repeat(a, n)], "id": np.concatenate([ids[x] for x in b]) if len(b) else np.array([], object), "cos": np.repeat(cos, n)})
    rows = rows.sort_values(["cid", "cos", "id"], ascending=[True, False, True], kind="stable")
    return rows.groupby("cid", sort=False).head(k + 1)


def valid_vectors(rows: DataFrame, key: str, vector: str, dims: int | None) -> DataFrame:
    v = F.col(vector)
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    ok = rows.filter(F.col(key).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite).select(F.col(key).alias("id"), v.cast("array<float>").alias("v"))
    if dims is None:
        top = ok.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").head()
        dims = top["d"] if top else 0
    return ok.filter(F.size("v") == dims)


def _packed(batches):
    """The vector as bytes: a task reads a thousand of them at once instead of number by number."""
    for b in batches:
        b["x"] = [np.asarray(v, "<f4").tobytes() for v in b["v"]]
        yield b[["cid", "ids", "x"]]


def similar_vectors(rows: DataFrame, key: str, vector: str, k: int = 5, least: float = 0.8, dims: int | None = None, probes: int | None = PROBES, eps: float | None = EPS) -> DataFrame:
    """(id, other, cos): for every row its k most similar other rows with a cosine of ``least`` or more. With ``probes`` None
    (all lists) and ``eps`` None nothing is left out: exact, at the price of meeting every vector."""
    spark = rows.sparkSession
    ok = durable(valid_vectors(rows, key, vector, dims).dropDuplicates(["id"]))
    # at most k + 1 ids of a class: first within salted parts of it, so a hot class is spread
    salted = Window.partitionBy("v", "salt").orderBy("id")
    few = ok.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64))).withColumn("rn", F.row_number().over(salted)).filter(F.col("rn") <= k + 1)
    few = few.withColumn("rn", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("rn") <= k + 1)
    classes = durable(few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("cid"), "ids", "v"))
    packed = durable(classes.select("cid", "ids", "v").mapInPandas(_packed, "cid string, ids array<string>, x binary"))
    n = packed.count()
    schema = "id string, other string, cos double"
    if n == 0:
        return spark.createDataFrame([], schema)
    lists = lists_for(n, probes or PROBES)
    sample = packed.select("x").orderBy(F.xxhash64("cid")).limit(min(SAMPLE_PER_LIST * lists + 1, SAMPLE_MOST))
    centres = fit_centres(unit(_stack([bytes(r[0]) for r in sample.collect()])), lists) if lists > 1 else None
    rot = rotation(len(packed.select("x").head()[0]) // 4)
    lists = len(centres) if centres is not None else 1
    probes = min(probes or lists, lists)
    shared = spark.sparkContext.broadcast((centres, rot))  # as many centres as the root of the vectors

    def assign(batches):
        c = shared.value[0]
        for b in batches:
            if not len(b):
                continue
            x = unit(_stack(b["x"])).astype(np.float32)
            if c is None:
                near = np.zeros((len(b), 1), np.int32)
            else:
                near = np.empty((len(b), probes), np.int32)
                for s in range(0, len(b), 1024):
                    sim = x[s : s + 1024] @ c.T
                    some = np.argpartition(-sim, probes - 1, axis=1)[:, :probes]
                    near[s : s + 1024] = np.take_along_axis(some, np.argsort(-np.take_along_axis(sim, some, 1), axis=1, kind="stable"), 1)
            b["near"] = list(near.astype(np.int32))
            yield b[["cid", "ids", "x", "near"]]

    placed = durable(packed.mapInPandas(assign, "cid string, ids array<string>, x binary, near array<int>"))
    home = placed.select("cid", "ids", "x", F.col("near")[0].alias("list"))
    probing = placed.select("cid", "x", F.explode("near").alias("list"))
    # blocks of a list and of its probes; one row for each list
    size = home.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    asked = probing.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("asks"))
    plan = F.broadcast(size.join(asked, "list"))
    home = home.join(plan, "list").withColumns({"part": F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"), "ask": F.explode(F.sequence(F.lit(0), F.col("asks") - 1))})
    probing = probing.join(plan, "list").withColumns({"ask": F.pmod(F.xxhash64("cid"), F.col("asks")).cast("int"), "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
    cell = ["list", "part", "ask"]

    def search(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({"cid": [], "id": [], "cos": []})
        ids = [np.asarray(i, object) for i in x["ids"]]
        xs, cid, found = unit(_stack(x["x"])), q["q_cid"].to_numpy(object), []
        for s in range(0, len(q), 2048):
            a, b, cos = scan(unit(_stack(q["q_x"].iloc[s : s + 2048])), xs, least, shared.value[1], k, eps=eps)
            found.append(_best(cid[s : s + 2048], ids, a, b, cos, k))
        return pd.concat(found)

    asking = probing.select(*[F.col(c).alias(f"q_{c}") for c in cell], F.col("cid").alias("q_cid"), F.col("x").alias("q_x"))
    found = home.select(*cell, "ids", "x").groupBy(*cell).cogroup(asking.groupBy(*[f"q_{c}" for c in cell])).applyInPandas(search, "cid string, id string, cos double")
    rank = Window.partitionBy("cid").orderBy(F.desc("cos"), "id")
    best = found.dropDuplicates(["cid", "id"]).withColumn("rn", F.row_number().over(rank)).filter(F.col("rn") <= k + 1)
    best = durable(best.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct((-F.col("cos")).alias("far"), "id"))).alias("best")))
    known = classes.join(best, "cid")
    members = known.select(F.explode("ids").alias("id"), "best")
    # rows beyond the k + 1 ids kept of their class; few classes are that large
    large = known.filter(F.size("ids") > k).select(F.col("v").alias("class_v"), "ids", "best")
    rest = ok.join(large, F.col("v") == F.col("class_v")).filter(~F.array_contains("ids", F.col("id"))).select("id", "best")
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("id")), 1, k)
    return members.unionByName(rest).select("id", F.explode(others).alias("o")).select("id", F.col("o.id").alias("other"), (-F.col("o.far")).alias("cos"))
