"""Vector near-duplicates against all pairs."""

import math
from collections import Counter

import numpy as np
import pytest

from txlake.llm import flat_graph
from txlake.llm.queries import QUERIES


def _truth(rows, cosine=0.98):
    """n_links and component of each row by comparing all."""
    usable = [
        (k, label, np.array(v, dtype=float)) for k, (_, v, label) in enumerate(rows)
        if v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for label, size in {(label, len(v)) for _, label, v in usable}:
        own = [(k, v) for k, lab, v in usable if lab == label and len(v) == size]
        x = np.array([v / np.abs(v).max() for _, v in own])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= cosine
        for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True):
            i, j = own[a][0], own[b][0]
            links[i] += 1
            links[j] += 1
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    return Counter((rows[k][0], links[k], least[root(k)], rows[k][0] == least[root(k)]) for k in range(len(rows)))


def _clusters(n, seed=0, dim=32, spread=0.02):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        centre = np.random.default_rng(1000 + int(rng.integers(n // 6))).normal(size=dim)
        v = centre + spread * rng.normal(size=dim) * (i % 5)
        rows.append((i, [float(x) for x in v], int(i % 2)))
    return rows


def _found(df):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_query_and_audit(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert _found(QUERIES["op9_flat_graph"](spark, sf_dir)) == _truth(rows)


@pytest.mark.parametrize("shard", [1500, 60])
def test_clusters_in_one_shard_and_in_many(spark, monkeypatch, shard):
    monkeypatch.setattr(flat_graph, "SHARD", shard)
    rows = _clusters(600)
    df = spark.createDataFrame(rows, SCHEMA)
    result = flat_graph.near_duplicate_vectors(df)
    truth, found = _truth(rows), _found(result)
    linked = sum(n * c for (_, n, _, _), c in truth.items())
    assert linked > 1000
    assert sum(n * c for (_, n, _, _), c in found.items()) >= 0.9 * linked
    exact = {i: n for i, n, _, _ in truth}
    assert all(n <= exact[i] for i, n, _, _ in found)
    assert 0.9 <= flat_graph.audit(df, result) <= 1


def test_alike_vectors_beyond_a_shard(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "SHARD", 50)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.ones(16) + 0.01 * rng.normal(size=16)], 1) for i in range(170)]
    assert _found(flat_graph.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA))) == _truth(rows)


@pytest.mark.parametrize("others", [(30,), (40, 30), (150, 150)])
def test_hot_cluster_beside_others(spark, monkeypatch, others):
    monkeypatch.setattr(flat_graph, "SHARD", 50)
    rng = np.random.default_rng(3)
    centres = [c for k, n in enumerate((150, *others)) for c in [np.eye(16)[k] + 0.1] * n]
    rows = [(i, [float(x) for x in c + 0.01 * rng.normal(size=16)], 1) for i, c in enumerate(centres)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _found(flat_graph.near_duplicate_vectors(df)) == _truth(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.001], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (11, [1.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [2e300, 0.0], 1),
        (13, [1e-300, 0.0], 1), (14, [1.0, 0.0, 0.0], 1), (15, [-1.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("node", "task", "links", "key", "weight", "n"):
        df = df.withColumn(name, df.vec_id)
    assert _found(flat_graph.near_duplicate_vectors(df)) == _truth(rows)
    assert flat_graph.near_duplicate_vectors(df.limit(0)).count() == 0
