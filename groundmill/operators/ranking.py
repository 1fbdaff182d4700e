"""Exact rank of rows by the cosine to each of a set of query rows, in blocks.

Queries are cut into blocks, rows into parts; a task multiplies one part with one block as matrices and keeps the
best of each query. The parts' best are merged by a window, so a task holds k rows for each query and part at most.
Every query meets every row: the work is queries times rows by definition, which is for stated query sets; for the neighbours
of all rows there is an index elsewhere.

Defined cases: null, empty and zero vectors, those with null or non-finite numbers and those of another length than the query
take no part; repeated rows of a key are one; ties go to the smaller key; no queries or no rows give no result."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries of a block; rows of a part, from which the number of parts follows.
BLOCK, PART = 2048, 50_000


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col(vector)
    fine = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.filter(F.col(key).isNotNull() & v.isNotNull() & fine).select(F.col(key).alias("id"), v.cast("array<double>").alias("v")).dropDuplicates(["id"])


def rank_by_cosine(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(query, id, cosine rounded to 6, rank from 1) of the ``k`` rows nearest to each query, the query's own row included."""
    q, r = usable(queries, key, vector), usable(rows, key, vector)
    n_q, n_r = (x.count() for x in (q, r))
    blocks, parts = -(-n_q // BLOCK) or 1, -(-n_r // PART) or 1
    kind = r.schema["id"].dataType.simpleString()
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumns({"q_block": place(blocks), "q_part": each(parts)}).withColumnsRenamed({"id": "q_id", "v": "q_v"})
    r = r.withColumns({"part": place(parts), "block": each(blocks)})

    def best(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(x) and len(y):
            of = x["v"].map(len)
            for d, ask in y.groupby(y["q_v"].map(len)):
                held = x[of == d].sort_values("id")
                if not len(held):
                    continue
                a, b = (np.stack(list(c)) for c in (ask["q_v"], held["v"]))
                a, b = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (a, b))
                ids = held["id"].to_numpy()
                for qid, row in zip(ask["q_id"], a, strict=True):
                    cos = np.round(b @ row, 6)
                    top = np.argsort(-cos, kind="stable")[:k]
                    out += [(qid, ids[i], cos[i]) for i in top]
        return pd.DataFrame(out, columns=["query", "id", "cosine"], dtype=object)

    found = r.groupBy("part", "block").cogroup(q.groupBy("q_part", "q_block")).applyInPandas(best, f"query {kind}, id {kind}, cosine double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine"), "id"))  # k rows for each part at most
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)
