"""Exact top-k search by inner product, with segment statistics that bound the score from coarse to fine."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import written

# Each level has so many times the segments of one component of the level before; the last has no others.
FINER = 4
SCALE = 256.0
CANDIDATES_A_BLOCK = 8192
QUERIES_A_BLOCK = 512
# Candidates of a first search, which gives every query a score to start from.
FIRST = 2048


def levels(size: int) -> list[int]:
    """How many of the first components are segments of their own, from one to all."""
    out = [1]
    while out[-1] * FINER < size:
        out.append(out[-1] * FINER)
    return out + [size] * (size > 1)


def cuts(size: int, single: int) -> np.ndarray:
    """Where segments start: the first components alone, then segments of doubling length, as later components vary less."""
    starts, length = list(range(min(single, size))), single
    at = single
    while at < size:
        starts.append(at)
        at, length = at + length, 2 * length
    return np.array(starts)


def statistics(x: np.ndarray, single: int) -> np.ndarray:
    """Means and deviations of each row's segments, each times the root of the segment's length."""
    starts = cuts(x.shape[1], single)
    n = np.diff(np.append(starts, x.shape[1]))
    mean = np.add.reduceat(x, starts, axis=1) / n
    spread = np.add.reduceat((x - np.repeat(mean, n, axis=1)) ** 2, starts, axis=1) / n
    return np.concatenate([mean, np.sqrt(spread)], 1) * np.tile(np.sqrt(n), 2)


def bounds(queries: np.ndarray, rows: np.ndarray, single: int) -> np.ndarray:
    """An upper bound of each inner product from the means and deviations of the segments of a level.

    The squared distance of two segments of length n is at least n times the squared distance of (mean, deviation); with the
    norms known, that bounds their product from above by n (mean mean' + deviation deviation').
    """
    product = statistics(queries, single) @ statistics(rows, single).T
    return product + 1e-9 * (1.0 + np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(rows, axis=1)[None, :])


def turned(rows: np.ndarray) -> np.ndarray:
    """Orthogonal directions of the rows from the strongest to the weakest, so that the strongest are in the finest segments."""
    return np.linalg.eigh(rows.T @ rows)[1][:, ::-1]


def best_of_block(query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, read: list | None = None) -> pd.DataFrame:
    """The k best rows of the block for each query that reach its ``least``, ties to smaller ids.

    Only rows whose bound reaches the k-th best score known so far go on to the next level, and only those of the last are
    scored. Queries and rows are turned alike before they are cut, which changes no product. ``read`` receives the number of
    rows that each query compares by all components.
    """
    size = rows.shape[1]
    out = []
    wide, narrow = rows.astype(np.float64), queries.astype(np.float64)
    alive = [np.flatnonzero(ids != q) for q in query_ids]
    least = least.astype(np.float64)
    if size:
        to = turned(wide)
        wide, narrow = wide @ to, narrow @ to
        length, other = np.linalg.norm(wide, axis=1), np.linalg.norm(narrow, axis=1)
        for single in levels(size):
            of_rows, of_queries = statistics(wide, single), statistics(narrow, single)
            if read is not None and single == size:
                read += map(len, alive)
            for i, left in enumerate(alive):
                mine = of_rows[left] @ of_queries[i]
                mine += 1e-9 * (1.0 + length[left] * other[i])
                if len(left) > k:
                    # The exact scores of the k rows of highest bound: the k-th best can't be lower.
                    top = left[np.argpartition(-mine, k - 1)[:k]]
                    least[i] = max(least[i], float(np.sort(rows[top] @ queries[i])[0]))
                alive[i] = left[mine >= least[i]]
    for i, left in enumerate(alive):
        score = rows[left] @ queries[i]
        order = np.lexsort((ids[left], -score))[:k]
        out.append(pd.DataFrame({"query_id": query_ids[i], "vec_id": ids[left][order], "score": score[order]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def top_k(vectors: DataFrame, is_query, k: int = 5, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest integer inner product for each row that ``is_query`` selects.

    Components are floor(256 x). A row is no candidate of its own query, nor are rows of the same id; rows that repeat count once. Null vectors and those with null or non-finite components take no part, nor do rows without an id; vectors are
    compared with those of their own length. An integer product beyond 64 bits is not supported: components up to 2**23 in
    size are exact. Every query block meets every candidate block once, each pair in a task of its own. A first search of about ``FIRST`` rows gives each query a score that later bounds must reach.
    """
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter("vec_id is not null and v is not null")
    whole = usable.filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    cut = whole.select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"), F.size("v").alias("size")).dropDuplicates(["vec_id", "v"])
    cut = written(cut, "vectors")
    queries = cut.filter(is_query)
    n, m = cut.count(), queries.count()
    blocks = max(1, -(-m // QUERIES_A_BLOCK))
    of = lambda salt, parts: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts)).cast("int")

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})]
        for size, own in q.groupby("size"):
            rows = c[c["size"] == size]
            if len(rows) and len(own):
                array = lambda d: np.array(d["v"].tolist(), np.int64).reshape(len(d), int(size))
                found.append(best_of_block(own["vec_id"].to_numpy(), array(own), own["least"].to_numpy(np.float64, na_value=-np.inf), rows["vec_id"].to_numpy(), array(rows), k))
        return pd.concat(found).astype("int64")

    def meet(asked: DataFrame, rows: DataFrame, cells: int) -> DataFrame:
        """The best of each cell of the rows for each query; every block of queries meets every cell."""
        # Both sides come from one table, so one takes names of its own.
        left = asked.toDF(*asked.columns).withColumn("block", of(1, blocks)).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
        right = rows.withColumn("cell", of(2, cells)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return left.groupBy("block", "cell").cogroup(right.groupBy("block", "cell")).applyInPandas(search, "query_id long, vec_id long, score long")

    # Some rows, chosen by hash, are searched first. Their k-th best score only lets bounds leave out more of the others.
    parts = max(1, n // FIRST)
    first = of(4, parts) == 0
    begun = written(meet(queries.withColumn("least", F.lit(None).cast("double")), cut.filter(first), 1), "first")
    known = begun.distinct().withColumn("at", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("at") == k)
    # An id with several vectors is several queries with one list of results; such ids start without a score.
    alone = queries.groupBy("vec_id").agg(F.count(F.lit(1)).alias("times")).filter("times = 1").select(F.col("vec_id").alias("query_id"))
    least = known.join(alone, "query_id").select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least"))
    rest = cut.filter(~first)
    scored = begun.unionByName(meet(queries.join(least, "vec_id", "left"), rest, max(1, -(-n // CANDIDATES_A_BLOCK))))
    ranked = scored.distinct().withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
