"""Searches and near-duplicates of vectors, mixing, the queries' SQL, and the pipeline."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadstream.llm import lattice, minhash, mixing, topk
from roadstream.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
VECTOR = "vec_id long, embedding array<float>, label int, key string, v string, cells string"


def edge_vectors():
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(120)]
    rows += [(200 + i, (np.array(rows[i % 4][1]) + rng.standard_normal(8) * 0.15).tolist()) for i in range(60)]
    rows += [(300, None), (301, [0.0] * 8), (302, [1.0, None] + [0.0] * 6), (303, [math.nan] * 8), (304, [math.inf] + [1.0] * 7), (305, []), (306, [1.0, 2.0]), (350, [1.0, 2.1])]
    rows += [(400, rows[0][1]), (401, rows[0][1]), (0, rows[0][1]), (None, rows[0][1]), (402, [-0.0] * 8)]
    return [(i, v, 1, "k", "v", "c") for i, v in rows]


def usable(v, zero):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))


@pytest.mark.parametrize(("block", "first"), [(7, 20), (8192, 2048)])
def test_top_k_equals_brute_force(spark, monkeypatch, block, first):
    monkeypatch.setattr(topk, "CANDIDATES_A_BLOCK", block)
    monkeypatch.setattr(topk, "FIRST", first)
    rows = edge_vectors()
    got = [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, VECTOR), F.col("vec_id") % 50 == 0).collect()]
    cut = sorted({(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, *_ in rows if i is not None and usable(v, True)})
    expected = []
    for q, x in cut:
        if q % 50 == 0:
            best = sorted({(-sum(a * b for a, b in zip(x, y)), i) for i, y in cut if i != q and len(x) == len(y)})[:5]
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(expected)
    assert topk.top_k(spark.createDataFrame([], VECTOR), F.col("vec_id") % 50 == 0).count() == 0


def test_segment_bounds_hold():
    rng = np.random.default_rng(0)
    q, x = rng.integers(-300, 300, (40, 13)).astype(float), rng.integers(-300, 300, (90, 13)).astype(float)
    for segments in (1, 4, 13):
        assert (topk.bounds(q, x, segments) >= q @ x.T - 1e-6).all()


def test_bounds_leave_out_most_rows_where_vectors_have_structure():
    """Vectors near few directions, turned at random: a small share reaches the level of all components, and the results are the exhaustive ones."""
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    x = np.floor(256 * (rng.standard_normal((3000, 64)) * 0.7 ** np.arange(64)) @ turn).astype(np.int64)
    ids, asked, read = np.arange(3000), np.arange(0, 3000, 50), []
    got = topk.best_of_block(asked, x[asked], np.full(len(asked), -np.inf), ids, x, 5, read)
    expected = []
    for q in asked:
        score = x @ x[q]
        expected += [(q, i, score[i]) for i in [i for i in np.lexsort((ids, -score)) if i != q][:5]]
    assert [tuple(r) for r in got.to_numpy()] == expected
    assert sum(read) < 0.05 * len(asked) * len(ids)


def brute_links(rows):
    unit = [np.array(np.float32(v), float) / np.linalg.norm(np.float32(v).astype(float)) if usable(v, False) and len(v) else None for _, v, *_ in rows]
    near = [[a is not None and b is not None and i != j and len(a) == len(b) and a @ b >= 0.9 for j, b in enumerate(unit)] for i, a in enumerate(unit)]
    names = [i for i, *_ in rows]
    label = list(range(len(rows)))
    for _ in range(len(rows)):
        new = [min([label[i], *(label[j] for j in range(len(rows)) if near[i][j])]) for i in range(len(rows))]
        if new == label:
            break
        label = new
    least = {}
    for n, l in zip(names, label):
        if n is not None:
            least[l] = min(n, least.get(l, n))
    return [(n, sum(r), least.get(l), n is not None and n == least.get(l)) for n, r, l in zip(names, near, label)]


def test_lattice_equals_brute_force(spark, monkeypatch):
    rows = edge_vectors()
    expected = sorted(brute_links(rows), key=str)
    table = spark.createDataFrame(rows, VECTOR)
    for block, bucket in ((1024, 16384), (4, 32)):
        monkeypatch.setattr(lattice, "BLOCK", block)
        monkeypatch.setattr(lattice, "ROWS_A_BUCKET", bucket)
        got = sorted((tuple(r) for r in lattice.near_duplicates(table).collect()), key=str)
        assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in expected)
        assert [r[0] for r in got] == [r[0] for r in expected]
        exact = sum(a == b for a, b in zip(got, expected))
        assert exact >= 0.8 * len(expected)
    assert lattice.near_duplicates(spark.createDataFrame([], VECTOR)).count() == 0


def test_lattice_recall_at_the_threshold():
    """Pairs at a cosine of just 0.9 in 64 dimensions meet in some cell."""
    rng = np.random.default_rng(5)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((3000, 64))
    b -= (b * a).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    for cosine, least in ((0.9, 0.9), (0.95, 0.99)):
        c = cosine * a + math.sqrt(1 - cosine**2) * b
        assert (lattice._first_meeting(lattice.cells_of(a), lattice.cells_of(c)) > 0).mean() >= least


def test_e8_points():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 8)) * 3
    near, other = lattice.nearest_e8(x)
    for points in (near, other):
        assert ((points % 2 == points[:, :1] % 2).all(1) & (points.sum(1) % 4 == 0)).all()
    # The covering radius of E8 is 1.
    assert (((x - near / 2) ** 2).sum(1) <= 1 + 1e-9).all()


def test_mixing_on_edges(spark, edge_docs, edge_rows):
    got = mixing.mix(edge_docs).collect()
    assert len(got) == len(edge_rows)
    assert [r["position"] for r in got] == sorted(r["position"] for r in got)
    total = sum(r["size"] for r in got)
    targets = {(r["source_size"], r["target"]) for r in got}
    assert sum(t for _, t in targets) == pytest.approx(1.5 * total)
    assert all(t <= 2 * s for s, t in targets) and all(0 <= r["taken"] <= 2 * r["size"] and 0 <= r["position"] <= 1 for r in got)
    for s, t in targets:
        assert abs(sum(r["taken"] for r in got if (r["source_size"], r["target"]) == (s, t)) - t) < 1


def test_every_pass_has_its_own_position(spark):
    """A source that is taken twice fills the whole of training, in the pipeline too, and copies lie a pass apart."""
    docs = spark.createDataFrame([(i, "w " * 10, "z" if i < 40 else "a") for i in range(400)], "doc_id long, text string, source string")
    for r in mixing.mix(docs).collect():
        assert sum(p["part"] for p in r["passes"]) == r["taken"] and r["passes"][0]["position"] == r["position"]
    twice = mixing.mix(docs, weights=(1.0, 9.0)).filter("taken = 20").collect()
    assert len(twice) >= 40
    second = [r["passes"][1]["position"] for r in twice]
    assert max(second) > 0.9 and all(r["passes"][0]["position"] < r["passes"][1]["position"] for r in twice)
    rows = [r["doc_id"] for r in corpus_pipeline.mix_sources(spark, docs, DATA).collect()]
    assert abs(len(rows) - 600) <= 2
    places = {}
    for at, d in enumerate(rows):
        places.setdefault(d, []).append(at)
    apart = [p[1] - p[0] for p in places.values() if len(p) == 2]
    assert len(apart) > 150 and min(apart) > 50


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "embeddings"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    expected = database.execute(ORACLE_SQL[name]).df()
    columns = sorted(expected.columns)
    got = QUERIES[name](spark, DATA).toPandas()
    assert sorted(got.columns) == columns
    order = lambda d: d[columns].sort_values(columns, ignore_index=True)
    assert order(got).values.tolist() == order(expected).values.tolist()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    seen = {"raw": docs.count()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, DATA), name)
        assert docs.columns == columns
        seen[name] = docs.count()
        if name == "near_dedup":
            parts = minhash.near_duplicates(docs.select("doc_id", "text"))
            assert parts.filter("not kept").isEmpty() and seen[name] == docs.select("doc_id").distinct().count()
    assert seen["raw"] > seen["quality"] > seen["near_dedup"] == seen["pii"]
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert tokens.filter("not intact or size(ids) <> n_tokens").isEmpty() and tokens.count() == docs.count()


def test_pipeline_stages_on_edges(spark, edge_docs, no_docs, tmp_path):
    spark.createDataFrame([(20, 1), (21, 0)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, str(tmp_path)).count() <= 3 * docs.count(), name


def test_rows_without_an_id_are_mixed_one_by_one(spark, tmp_path):
    """Two sources of rows that no id tells apart: each gets the copies that the plan gives to its rows, and texts without words go."""
    rows = [(None, f"{s} " * 10, s) for s in "ab" for _ in range(10)] + [(1, " ", "a"), (2, None, "b"), (3, "a " * 10, "a"), (3, "a " * 10, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "docs"))
    for table in (docs, spark.read.parquet(str(tmp_path / "docs"))):
        plan = mixing.mix(table).filter("size > 0").collect()
        copies = sum(2 * p["part"] >= r["size"] for r in plan for p in r["passes"])
        got = corpus_pipeline.mix_sources(spark, table, DATA).collect()
        assert len(got) == copies and not any((r["text"] or "").strip() == "" for r in got)
        # Weights 5 and 2 of 36 texts: one source twice (24 copies), the other filled to its target.
        assert sum(r["source"] == "a" for r in got) == 24 and 0 < sum(r["source"] == "b" for r in got) <= 20
