"""Near-duplicate embeddings: random projections decoded to points of the E8 lattice, in several tables.

Vectors in one cell, or in cells that one of them probes, are compared by cosine. A pair that meets in several tables or
cells is counted at the first alone, so links are counted without any list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import mix, written
from roadstream.llm.graph import components

TABLES = 16
# E8 points in a cell's name: 16 projections a table.
POINTS = 2
# Length of a unit vector's projection on one direction, in units of the lattice.
WIDTH = 0.55
THRESHOLD = 0.9
SEED = 20
# A cell's vectors are compared in blocks of about so many.
BLOCK = 1024
ROWS_A_BUCKET = 16384


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest point of D8 (integers of even sum): round, and where the sum is odd round the worst one the other way."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(-1).astype(np.int64) & 1)
    rest = x[odd] - near[odd]
    worst = np.abs(rest).argmax(-1)
    near[odd, worst] += np.where(rest[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest point of E8, and the nearest of its other coset of D8, which is a neighbour; both doubled, so whole."""
    plain, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    closer = (((x - plain) ** 2).sum(-1) <= ((x - half) ** 2).sum(-1))[:, None]
    return (2 * np.where(closer, plain, half)).astype(np.int64), (2 * np.where(closer, half, plain)).astype(np.int64)


def _named(points: np.ndarray) -> np.ndarray:
    out = np.full(len(points), 0x9E3779B97F4A7C15, np.uint64)
    for column in points.T:
        out = mix(out ^ column.astype(np.uint64))
    return out


def cells_of(unit: np.ndarray) -> np.ndarray:
    """rows x TABLES x 2**POINTS cell names: the own cell first, then those probed (a neighbour in some of the points)."""
    dimension = unit.shape[1]
    out = np.empty((len(unit), TABLES, 1 << POINTS), np.uint64)
    for table in range(TABLES):
        rng = np.random.default_rng([SEED, table, dimension])
        direction = rng.standard_normal((dimension, 8 * POINTS)) * WIDTH
        offset = rng.random(8 * POINTS) * 2
        projected = (unit @ direction + offset).reshape(len(unit), POINTS, 8)
        names = [[_named(p) for p in nearest_e8(projected[:, i])] for i in range(POINTS)]
        for way in range(1 << POINTS):
            name = np.full(len(unit), np.uint64(table * 2 + 1))
            for i in range(POINTS):
                name = mix(name * np.uint64(0x9E3779B97F4A7C15) + names[i][way >> i & 1])
            out[:, table, way] = mix(name + np.uint64(dimension))
    return out


def _units(vectors: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows by length: places and unit vectors."""
    sizes = np.array([len(v) for v in vectors])
    out = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = np.array([vectors[i] for i in at], np.float64).reshape(len(at), size)
        x = x / np.abs(x).max(1, keepdims=True)
        out[int(size)] = at, x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cell at which pairs of rows meet first: by table, then a's own cell, then b's. Zero if nowhere."""
    out = np.zeros(len(a), np.uint64)
    for table in range(TABLES - 1, -1, -1):
        x, y = a[:, table], b[:, table]
        out = np.where((y[:, :1] == x).any(1), y[:, 0], out)
        out = np.where((x[:, :1] == y).any(1), x[:, 0], out)
    return out


def pairs_within(sizes: np.ndarray, most: int, active: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (a, b), a before b, of all pairs of rows that share a run, where runs of these sizes follow each other.

    With ``active``, only pairs whose first row is active.
    """
    starts = np.cumsum(sizes) - sizes
    ends = np.repeat(starts + sizes, sizes)
    partners = ends - 1 - np.arange(len(ends))
    if active is not None:
        partners = np.where(active, partners, 0)
    total = np.cumsum(partners)
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, side="right")))
        n = partners[at:stop]
        a = np.repeat(np.arange(at, stop), n)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        at = stop


def links_of(keys: np.ndarray, unit: np.ndarray, cells: np.ndarray, groups: np.ndarray, cell: np.ndarray, side: np.ndarray, across: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked pairs: rows of one group, and of its two sides where the group is a pair of two blocks.

    Rows come sorted by group. A pair is given by the cell where it meets first, and by no other.
    """
    ends = np.flatnonzero(np.append(groups[1:] != groups[:-1], True)) + 1
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in pairs_within(np.diff(ends, prepend=0), 1 << 16):
        keep = np.flatnonzero(~across[a] | (side[a] != side[b]))
        a, b = a[keep], b[keep]
        keep = np.flatnonzero(np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold)
        a, b = a[keep], b[keep]
        swap = keys[a] > keys[b]
        low, high = np.where(swap, b, a), np.where(swap, a, b)
        here = _first_meeting(cells[low], cells[high]) == cell[a]
        found_a.append(low[here])
        found_b.append(high[here])
    return np.concatenate(found_a), np.concatenate(found_b)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Equal vectors are handled as one, which stands for all its rows; their links among each other count. Vectors that are
    null, empty, zero, or hold null or non-finite components link with nothing and form components of their own. Vectors of
    different lengths are not compared. Rows that share an id are separate vectors in counts and one node in components; a
    row without an id takes part, but its component is named by the others (null if it has none). Other columns are left out.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    usable = F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    # -0.0 is 0.0.
    keyed = written(rows.select("vec_id", F.when(usable, F.transform("v", lambda x: x + F.lit(0.0))).alias("v")).withColumn("key", F.when(F.col("v").isNotNull(), F.xxhash64("v"))), "vectors")
    distinct = written(keyed.filter("key is not null").groupBy("key").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("least")), "distinct")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, unit in _units(batch["v"].tolist()).values():
                cells = cells_of(unit)
                flat = cells.reshape(len(at), -1).astype(np.int64)
                yield pd.DataFrame({"key": batch["key"].to_numpy()[at], "cells": list(flat)})

    own = written(distinct.select("key", "v").mapInPandas(place, "key long, cells array<long>"), "cells")
    ways = 1 << POINTS
    listed = own.select("key", F.posexplode("cells").alias("at", "cell")).select("key", "cell", (F.col("at") % ways == 0).alias("home"))
    crowded = listed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("settled")).filter("n > 1 and settled").select(F.col("cell").alias("c"), "n")
    together = listed.join(crowded, F.col("cell") == F.col("c")).select("key", "cell", "n")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = together.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("key", F.lit(3)), F.col("blocks")).cast("int"))
    # Each pair of blocks of a cell is a task's work of its own; a cell of one block has one.
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") <= F.col("other")).alias("first")
    )
    # Groups are handled many at a time: a bucket holds about so many rows of whole groups.
    buckets = max(1, -(-paired.count() // ROWS_A_BUCKET))
    bucketed = paired.withColumn("bucket", F.pmod(F.xxhash64("cell", "i", "j"), F.lit(buckets)))
    full = bucketed.join(distinct.select("key", "v", "times"), "key").join(own, "key")

    def link(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["cell", "i", "j", "key"], ignore_index=True)
        found = [pd.DataFrame({"key": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "other": pd.Series(dtype="int64")})]
        for at, unit in _units(batch["v"].tolist()).values():
            part = batch.iloc[at]
            keys, times = part["key"].to_numpy(), part["times"].to_numpy()
            cells = np.array(part["cells"].tolist(), np.int64).astype(np.uint64).reshape(len(at), TABLES, ways)
            groups = part.groupby(["cell", "i", "j"], sort=False).ngroup().to_numpy()
            a, b = links_of(keys, unit, cells, groups, part["cell"].to_numpy().astype(np.uint64), part["first"].to_numpy(), (part["i"] != part["j"]).to_numpy(), threshold)
            if len(a):
                own_links = np.bincount(a, times[b], len(keys)) + np.bincount(b, times[a], len(keys))
                counted = pd.DataFrame({"key": keys, "links": own_links.astype(np.int64), "other": keys})
                found.append(counted[counted["links"] > 0])
                # For the components a forest of the links is enough.
                found.append(_forest(keys, keys, a, b))
        return pd.concat(found).astype("int64")

    linked = written(full.groupBy("bucket").applyInPandas(link, "key long, links long, other long"), "links")
    counts = linked.groupBy("key").agg(F.sum("links").alias("links"))
    edges = linked.filter("key <> other").select(F.col("key").alias("a"), F.col("other").alias("b"))
    parts = components(edges)
    classes = distinct.select("key", "times", "least").join(parts.withColumnRenamed("node", "key"), "key", "left").join(counts, "key", "left").withColumn("component", F.coalesce("component", "key"))
    named = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    known = classes.join(named, "component").select("key", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id")
    out = keyed.select("vec_id", "key").join(known, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _forest(k1: np.ndarray, k2: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Edges that connect what the links (a, b) connect, at most one for each row but a component's first."""
    nodes, inverse = np.unique(np.concatenate([k1[a], k2[b]]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    joined = np.flatnonzero(root != np.arange(len(nodes)))
    return pd.DataFrame({"key": nodes[joined], "links": 0, "other": nodes[root[joined]]})
