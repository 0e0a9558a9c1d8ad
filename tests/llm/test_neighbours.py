import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import neighbours
from kinfold.llm.neighbours import KdTree, chi_square_quantile, search, top_k


def frame(spark, vectors, group="g"):
    rows = [(group, f"{i:05}", [float(x) for x in v] if v is not None else None) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "field string, hash string, v array<float>").withColumn("grp", F.lit(1)).withColumn("id", F.lit("z")).withColumn("query", F.lit(False))


def clusters(n, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 5, dim))
    x = np.repeat(centres, 5, 0) + 0.12 * rng.standard_normal((n // 5 * 5, dim))
    return (x * rng.uniform(0.3, 4, (len(x), 1))).astype(np.float32)


def brute(x, k):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return s, np.argsort(-s, axis=1, kind="stable")[:, :k]


def test_quantile():
    assert chi_square_quantile(0.95, 2) == pytest.approx(5.9915, abs=1e-3) and chi_square_quantile(0.99, 8) == pytest.approx(20.0902, abs=1e-3)


def test_tree():
    x = np.random.default_rng(0).standard_normal((5000, 6))
    t = KdTree(x, 100)
    assert sorted(t.order) == list(range(5000)) and max(np.diff(t.edges)) <= 100
    KdTree(np.zeros((1000, 3)), 50)  # equal points still split


def test_search_recall():
    x = clusters(3000)
    s, near = brute(x, 5)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    p = (u @ neighbours.projection(24, 12)).astype(np.float32)
    q, r, _ = search(u.astype(float), p, u.astype(float), p, 5, chi_square_quantile(0.995, 12), None, np.arange(len(x)))
    got = set(zip(q, r, strict=True))
    assert np.mean([(i, j) in got for i in range(len(x)) for j in near[i]]) > 0.97


@pytest.mark.parametrize("floor", [None, 0.9])
def test_blocks(spark, monkeypatch, floor):
    monkeypatch.setattr(neighbours, "BLOCK_LEAST", 200)
    monkeypatch.setattr(neighbours, "BLOCK_MOST", 300)
    monkeypatch.setattr(neighbours, "LEAF", 64)
    x = clusters(1200)
    s, near = brute(x, 5)
    want = {(f"{i:05}", f"{j:05}") for i in range(len(x)) for j in near[i] if floor is None or s[i, j] >= floor}
    rows = top_k(frame(spark, x), "field", "hash", "v", 5, floor).collect()
    got = {(r.hash, r.neighbour) for r in rows}
    assert len(got & want) / len(want) > 0.97 and len(rows) == len(got)
    assert all(abs(r.cosine - s[int(r.hash), int(r.neighbour)]) < 1e-6 for r in rows)
    if floor is None:
        assert len(rows) == 5 * len(x)


@pytest.mark.parametrize("cells,most", [(64, 0.2), (256, 0.12), (1024, 0.06)])
def test_rows_are_sent_to_few_blocks(cells, most):
    """At a cosine of 0.9, of all pairs that are so similar at least 0.98 meet, and the copies of a row grow much slower than the blocks."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((20_000, 64))
    y = 0.9 * x / np.linalg.norm(x, axis=1, keepdims=True)
    n = rng.standard_normal(x.shape)
    n -= (n * x).sum(1, keepdims=True) * x / (x * x).sum(1, keepdims=True)
    y += np.sqrt(1 - 0.81) * n / np.linalg.norm(n, axis=1, keepdims=True)  # a neighbour at the cosine 0.9 exactly
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    p, q = u @ neighbours.projection(64, 12), y @ neighbours.projection(64, 12)
    tree = neighbours.TopTree(p, cells)
    (rp, cp), (rq, cq) = (tree.visits(z, np.full(len(z), 0.9), neighbours.COVERED) for z in (p, q))
    of_p, of_q = set(zip(rp.tolist(), cp.tolist(), strict=True)), set(zip(rq.tolist(), cq.tolist(), strict=True))
    assert (cp[: len(p)] == tree.cell(p)).all() and len(of_p) == len(rp)
    met = [(i, b) in of_p or (i, a) in of_q for i, (a, b) in enumerate(zip(tree.cell(p).tolist(), tree.cell(q).tolist(), strict=True))]
    assert np.mean(met) >= 0.98
    assert len(rp) / len(p) < most * cells


def test_normal_cdf():
    assert np.allclose(neighbours.normal_cdf(np.array([-np.inf, -1.96, 0.0, 1.0, np.inf])), [0, 0.0249979, 0.5, 0.8413447, 1], atol=1e-6)


def test_wide_vectors_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 4 * 1536 * 100)
    x = clusters(600, 1536)
    s, near = brute(x, 5)
    want = {(f"{i:05}", f"{j:05}") for i in range(len(x)) for j in near[i] if s[i, j] >= 0.9}
    got = {(r.hash, r.neighbour) for r in top_k(frame(spark, x), "field", "hash", "v", 5, 0.9).collect()}
    assert want and len(got & want) / len(want) > 0.97


def test_asked_only(spark):
    x = clusters(400)
    df = frame(spark, x).withColumn("asked", F.col("hash") < "00020")
    _, near = brute(x, 3)
    got = {(r.hash, r.neighbour) for r in top_k(df, "field", "hash", "v", 3, query="asked").collect()}
    assert len(got) == 60 and len(got & {(f"{i:05}", f"{j:05}") for i in range(20) for j in near[i]}) > 56


def test_copies(spark):
    one = [1.0, 0.0, 0.0]
    x = [one] * 40 + [[0.99, 0.1, 0.0], [0.0, 1.0, 0.0]]
    rows = top_k(frame(spark, x), "field", "hash", "v", 3, 0.9).collect()
    by = {}
    for r in rows:
        by.setdefault(r.hash, []).append((r.neighbour, round(r.cosine, 6)))
    assert sorted(by["00000"]) == [("00001", 1.0), ("00002", 1.0), ("00003", 1.0)] and sorted(n for n, _ in by["00030"]) == ["00000", "00001", "00002"]
    assert sorted(n for n, _ in by["00040"]) == ["00000", "00001", "00002"] and "00041" not in by and len(by) == 41


def test_unusable_and_empty(spark):
    x = [[1.0, 0.0], [1.0, 0.1], None, [], [0.0, 0.0], [float("nan"), 1.0], [1.0, 0.0, 0.0]]
    df = frame(spark, x)
    assert {(r.hash, r.neighbour) for r in top_k(df.unionByName(df), "field", "hash", "v", 2).collect()} == {("00000", "00001"), ("00001", "00000")}
    assert top_k(df.limit(0), "field", "hash", "v", 2).count() == 0
