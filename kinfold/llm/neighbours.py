"""Most similar vectors: stable projections into few dimensions, kd-trees over them, and incremental search that a chi-square test stops."""

from __future__ import annotations

from collections.abc import Iterator
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators.skew import lookup_join
from kinfold.scratch import Scratch

#: Dimensions of the projection (even), confidence of the stopping test, rows behind the top tree at most.
DIMENSIONS, CONFIDENCE, FIT_ROWS = 12, 0.995, 20_000
#: Share of the probability of where a neighbour lies that the blocks a row is sent to must cover.
COVERED = 0.97
#: Rows of a block at least and at most, bytes of its vectors at most, blocks of a group at most (beyond it a block has more parts),
#: and rows sent to a task for each of the block's own.
BLOCK_LEAST, BLOCK_MOST, BLOCK_BYTES, BLOCKS, VISITORS = 8_192, 131_072, 8 << 20, 4_096, 4
LEAF = 512


def chi_square_quantile(p: float, m: int) -> float:
    """For even m, where the distribution function has a closed form."""

    def cdf(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - exp(-x / 2) * total

    low, high = 0.0, 40.0 * m
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < p else (low, middle)
    return high


def projection(dim: int, m: int) -> np.ndarray:
    """Gaussian (2-stable) directions, the same for each run: a squared projected distance is the squared distance times a chi-square variable of m degrees."""
    return np.random.default_rng(20_011 + dim).standard_normal((dim, m)).astype(np.float32)


class KdTree:
    """Median splits along the widest dimension down to leaves; `order` lists the rows leaf by leaf."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        parts, todo = [], [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= leaf:
                parts.append(rows)
                continue
            p = points[rows]
            d = int((p.max(0) - p.min(0)).argmax())
            half = len(rows) // 2
            at = np.argpartition(p[:, d], half)
            todo += [rows[at[:half]], rows[at[half:]]]
        self.order = np.concatenate(parts)
        self.edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        self.low = np.stack([points[p].min(0) for p in parts])
        self.high = np.stack([points[p].max(0) for p in parts])

    def apart(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Squared distance of each leaf's box to the given box."""
        gap = np.maximum(0, np.maximum(self.low - high, low - self.high))
        return (gap * gap).sum(1)


class _Best:
    """The k best of each row so far, and the squared projected distance beyond which the stopping test drops others."""

    def __init__(self, rows: int, k: int, chi: float, most: float):
        self.cos = np.full((rows, k), -np.inf)
        self.at = np.full((rows, k), -1, np.int64)
        self.limit = np.full(rows, chi * most)
        self.k, self.chi, self.most = k, chi, most

    def update(self, q: np.ndarray, r: np.ndarray, cos: np.ndarray) -> None:
        good = cos > self.cos[q, -1]
        q, r, cos = q[good], r[good], cos[good]
        if not len(q):
            return
        # put the new ones behind the old and keep the k best of each row that has any
        touched, inverse = np.unique(q, return_inverse=True)
        sort = np.lexsort((r, -cos, inverse))
        inverse, r, cos = inverse[sort], r[sort], cos[sort]
        rank = np.arange(len(inverse)) - np.searchsorted(inverse, inverse)
        keep = rank < self.k
        new_c = np.full((len(touched), self.k), -np.inf)
        new_r = np.full((len(touched), self.k), -1, np.int64)
        new_c[inverse[keep], rank[keep]] = cos[keep]
        new_r[inverse[keep], rank[keep]] = r[keep]
        both_c, both_r = np.hstack([self.cos[touched], new_c]), np.hstack([self.at[touched], new_r])
        top = np.argsort(-both_c, axis=1, kind="stable")[:, : self.k]
        self.cos[touched] = np.take_along_axis(both_c, top, 1)
        self.at[touched] = np.take_along_axis(both_r, top, 1)
        kth = self.cos[touched, -1]
        self.limit[touched] = self.chi * np.minimum(self.most, np.where(np.isfinite(kth), 2 - 2 * kth, 4.0))

    def found(self, order: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, c = np.nonzero(self.at >= 0)
        return order[q], other[self.at[q, c]], self.cos[q, c]


def _verified(v: np.ndarray, w: np.ndarray, mask: np.ndarray, floor: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    q, r = np.nonzero(mask)
    if not len(q):
        return q, r, np.empty(0)
    cos = np.einsum("ij,ij->i", v[q], w[r]) if len(q) * 4 < mask.size else (v @ w.T)[q, r]
    if floor is not None:
        good = cos >= floor - 1e-12
        q, r, cos = q[good], r[good], cos[good]
    return q, r, cos


def search(qv: np.ndarray, qp: np.ndarray, dv: np.ndarray, dp: np.ndarray, k: int, chi: float, floor: float | None, self_at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, cosine) of up to k most similar rows for each query; `self_at` is the row that is the query itself (-1: none).

    Queries go leaf by leaf. Leaves of the data come in order of the projected distance of their boxes; rows nearer than
    the stopping radius in the projection are verified by their true cosine. The radius of a query is the chi-square
    quantile times the k-th best true distance so far (or that of `floor`, below which nothing is wanted), and the search ends
    when the next leaf lies beyond the radius of every query of the leaf.
    """
    data, queries = KdTree(dp), KdTree(qp)
    dv, dp, qv, qp = dv[data.order], dp[data.order], qv[queries.order], qp[queries.order]
    norms, squares = (dp * dp).sum(1), (qp * qp).sum(1)
    position = np.empty(len(data.order), np.int64)
    position[data.order] = np.arange(len(data.order))
    own = np.full(len(qv), -1) if self_at is None else np.where(self_at >= 0, position[self_at], -1)[queries.order]
    best = _Best(len(qv), k, chi, 2 - 2 * floor if floor is not None else 4.0)
    for i in range(len(queries.edges) - 1):
        a, b = queries.edges[i], queries.edges[i + 1]
        near = data.apart(queries.low[i], queries.high[i])
        for leaf in np.argsort(near):
            if near[leaf] > best.limit[a:b].max():
                break
            c, d = data.edges[leaf], data.edges[leaf + 1]
            mask = squares[a:b, None] + norms[c:d] - 2 * (qp[a:b] @ dp[c:d].T) <= best.limit[a:b, None]
            here = (own[a:b] >= c) & (own[a:b] < d)
            mask[here, own[a:b][here] - c] = False
            q, r, cos = _verified(qv[a:b], dv[c:d], mask, floor)
            best.update(a + q, c + r, cos)
    return best.found(queries.order, data.order)


def search_both(v: np.ndarray, p: np.ndarray, w: np.ndarray, o: np.ndarray, k: int, chi: float, floor: float | None, same: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """`search` of each side against the other (or with `same` of the rows among themselves), with every distance taken once for both."""
    one = KdTree(p)
    two = one if same else KdTree(o)
    v, p = v[one.order], p[one.order]
    w, o = (v, p) if same else (w[two.order], o[two.order])
    squares, norms = (p * p).sum(1), (o * o).sum(1)
    most = 2 - 2 * floor if floor is not None else 4.0
    left = _Best(len(v), k, chi, most)
    right = left if same else _Best(len(w), k, chi, most)
    for i in range(len(one.edges) - 1):
        a, b = one.edges[i], one.edges[i + 1]
        near = two.apart(one.low[i], one.high[i])
        for leaf in np.argsort(near):
            if near[leaf] > chi * most:
                break
            c, d = two.edges[leaf], two.edges[leaf + 1]
            if (same and leaf < i) or near[leaf] > max(left.limit[a:b].max(), right.limit[c:d].max()):
                continue
            mask = squares[a:b, None] + norms[c:d] - 2 * (p[a:b] @ o[c:d].T) <= np.maximum(left.limit[a:b, None], right.limit[c:d])
            if same and leaf == i:
                mask = np.triu(mask, 1)
            q, r, cos = _verified(v[a:b], w[c:d], mask, floor)
            left.update(a + q, c + r, cos)
            right.update(c + r, a + q, cos)
    return [left.found(one.order, two.order)] if same else [left.found(one.order, two.order), right.found(two.order, one.order)]


def normal_cdf(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, to 1e-7 (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * np.abs(x))
    tail = np.exp(-x * x / 2) * 0.3989422804014327 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(x > 0, 1 - tail, tail)


class TopTree:
    """Splits of the projected space into 2**depth cells, fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.dims: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        parts = [sample]
        low = np.full((1, sample.shape[1]), -np.inf)
        high = np.full((1, sample.shape[1]), np.inf)
        #: bounds of the cells of each level
        self.low, self.high = [low], [high]
        while 2 ** len(self.dims) < cells:
            dims, values, following = [], [], []
            for p in parts:
                d = int((p.max(0) - p.min(0)).argmax()) if len(p) else 0
                value = float(np.median(p[:, d])) if len(p) else 0.0
                dims.append(d)
                values.append(value)
                following += [p[p[:, d] <= value], p[p[:, d] > value]]
            self.dims.append(np.array(dims))
            self.values.append(np.array(values))
            low, high = np.repeat(low, 2, 0), np.repeat(high, 2, 0)
            at = np.arange(len(parts))
            high[2 * at, dims] = np.minimum(high[2 * at, dims], values)
            low[2 * at + 1, dims] = np.maximum(low[2 * at + 1, dims], values)
            self.low.append(low)
            self.high.append(high)
            parts = following

    def cell(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        for dims, values in zip(self.dims, self.values, strict=True):
            at = 2 * at + (points[np.arange(len(points)), dims[at]] > values[at])
        return at

    def visits(self, points: np.ndarray, cosine: np.ndarray, covered: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell): the cells, the own one first, that hold a neighbour of the given cosine with the probability `covered` together.

        Of a unit vector with projection x, another one at the cosine c has a projection that is normal around c * x with the variance
        1 - c * c in every direction, so the probability of a cell is a product of normal probabilities, one for each
        dimension. Cells are found down the tree; those that are very unlikely are left with all below them.
        """
        sd = np.sqrt(np.maximum(1e-9, 1 - cosine * cosine))
        mean = points * cosine[:, None]
        row, node, p = np.arange(len(points)), np.zeros(len(points), np.int64), np.ones(len(points))
        least = (1 - covered) / (8 * max(1, len(self.low[-1])))
        for level, (dims, values) in enumerate(zip(self.dims, self.values, strict=True)):
            d = dims[node]
            x, s = mean[row, d], sd[row]
            lower, upper = normal_cdf((self.low[level][node, d] - x) / s), normal_cdf((self.high[level][node, d] - x) / s)
            share = np.clip((normal_cdf((values[node] - x) / s) - lower) / np.maximum(upper - lower, 1e-300), 0, 1)
            row, node, p = np.concatenate([row, row]), np.concatenate([2 * node, 2 * node + 1]), np.concatenate([p * share, p * (1 - share)])
            keep = p >= least
            row, node, p = row[keep], node[keep], p[keep]
        own = self.cell(points)
        order = np.lexsort((-p, node != own[row], row))
        row, node, p = row[order], node[order], p[order]
        before = np.cumsum(p) - p
        start = np.searchsorted(row, row)
        keep = (before - before[start] < covered) & (node != own[row])
        return np.concatenate([np.arange(len(points)), row[keep]]), np.concatenate([own, node[keep]])


def _project(trees: dict[tuple[str, int], TopTree], m: int):
    """Adds block, vector and projection as bytes to (grp, dim, id, v, query)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(1).to_numpy(zero_copy_only=False)
            groups = np.array(b.column(0).to_pylist(), object)
            for g, dim in {(g, int(d)) for g, d in zip(groups, dims, strict=True)}:
                rows = b.filter(pa.array((groups == g) & (dims == dim)))
                flat = rows.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)
                unit = flat / np.linalg.norm(flat.astype(np.float64), axis=1, keepdims=True)
                p = (unit @ projection(dim, m)).astype(np.float32)
                tree = trees.get((g, dim))
                block = np.zeros(len(p), np.int64) if tree is None else tree.cell(p)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), rows.column(4), pa.array(block, pa.int64()), pa.array([x.tobytes() for x in flat], pa.binary()), pa.array([x.tobytes() for x in p], pa.binary())],
                    names=["grp", "dim", "id", "query", "block", "v", "p"],
                )

    return run


_PROJECTED = "grp string, dim int, id string, query boolean, block bigint, v binary, p binary"


def top_k(vectors: DataFrame, group: str, key: str, vector: str, k: int = 5, floor: float | None = None, query: str | None = None, dimensions: int = DIMENSIONS, confidence: float = CONFIDENCE, covered: float = COVERED) -> DataFrame:
    """(group, key, neighbour, cosine): up to k most similar others of every key within its group; groups and keys as strings.

    `floor` is a cosine below which no neighbour is wanted, `query` a boolean column: only keys where it is true are
    searched for (against all). Equal cosines go by the smaller key. Vectors that are null, empty, of zero length or hold
    nulls or NaN take no part; vectors of another dimension are another group. Repeated rows count once. Within a block each true
    neighbour is verified with at least the probability `confidence` (the chi-square test's); the cosines are exact.

    Exact copies are searched once: the tree holds distinct vectors, and copies get each other and their representative's
    neighbours afterwards. The space is cut into blocks of a bounded number of rows by a top tree fitted on at most
    FIT_ROWS rows; every row is indexed. A row is sent to its own block and to those that hold its neighbours with the probability
    `covered`, at the cosine of `floor`, or without one at that of the k-th neighbour in its own block, which a first round finds. Whoever
    meets there counts for both, so a pair is missed only if neither of the two is sent to the other's block.
    """
    scratch = Scratch(vectors.sparkSession, "neighbours")
    v = F.col(vector)
    usable = v.isNotNull() & (F.size(v) > 0) & F.col(key).isNotNull() & F.col(group).isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(usable).select(F.col(group).cast("string").alias("grp"), F.col(key).cast("string").alias("id"), v.cast("array<float>").alias("v"), (F.col(query) if query else F.lit(True)).alias("query"))
    rows = rows.groupBy("grp", "id").agg(F.min("v").alias("v"), F.max("query").alias("query"))
    copies = rows.groupBy("grp", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.max("query").alias("query"))
    distinct = scratch.save(copies.select("grp", F.size("v").alias("dim"), "id", "v", "query", "n"))
    members = None
    if distinct.where("n > 1").limit(1).count():
        members = scratch.save(lookup_join(rows, distinct.where("n > 1").select("grp", "v", F.col("id").alias("rep"), "n"), ["grp", "v"], "id", how="inner").select("grp", "rep", "n", "id", "query"))

    # top trees, from a bounded sample of each group
    counts = {(r.grp, r.dim): r.n for r in distinct.groupBy("grp", "dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    aim = {g: max(1, min(BLOCK_BYTES // (4 * g[1]), BLOCK_MOST, max(BLOCK_LEAST, n // 24))) for g, n in counts.items()}
    cells = {g: min(BLOCKS, 1 << max(0, -(-n // aim[g]) - 1).bit_length()) for g, n in counts.items()}
    trees: dict[tuple[str, int], TopTree] = {}
    large = [g for g in counts if cells[g] > 1]
    if large:
        share = F.lit(0.0)
        for g, dim in large:
            share = F.when((F.col("grp") == g) & (F.col("dim") == dim), F.lit(min(1.0, FIT_ROWS / counts[g, dim]))).otherwise(share)
        sample = distinct.where(F.shiftrightunsigned(F.xxhash64("id"), 1) <= share * float(2**63)).select("grp", "dim", "v").toPandas()
        for (g, dim), part in sample.groupby(["grp", "dim"]):
            x = np.stack(part.v.to_numpy()).astype(np.float32)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            trees[g, dim] = TopTree(x @ projection(dim, dimensions), cells[g, dim])
    projected = scratch.save(distinct.select("grp", "dim", "id", "v", "query").mapInArrow(_project(trees, dimensions), _PROJECTED))
    chi = chi_square_quantile(confidence, dimensions)
    one_way = query is not None
    hits = None
    visits = projected.withColumn("cosine", F.lit(floor if floor is not None else 1.0).cast("double"))
    if floor is None and large:
        # the first round stays at home; what it finds tells how far to go
        hits = scratch.save(_searched(projected.withColumn("home", F.lit(True)), aim, k, chi, floor, dimensions, one_way))
        kth = _first(hits, k).groupBy("grp", "id").agg(F.when(F.count(F.lit(1)) == k, F.min("cosine")).alias("cosine"))
        visits = projected.join(kth, ["grp", "id"], "left").withColumn("cosine", F.greatest(F.lit(0.0), F.coalesce("cosine", F.lit(0.0)))).select(*projected.columns, "cosine")
    if large:
        visits = scratch.save(visits.mapInArrow(_sent(trees, dimensions, covered, one_way), _VISITS))
    else:
        visits = visits.withColumn("home", F.lit(True))
    found = _searched(visits, aim, k, chi, floor, dimensions, one_way)
    best = _first((found if hits is None else hits.unionByName(found)).groupBy("grp", "id", "neighbour").agg(F.max("cosine").alias("cosine")), k)
    if members is not None:
        best = _with_copies(best, members, k, scratch)
        if query:
            best = best.join(rows.where("query").select("grp", "id"), ["grp", "id"], "left_semi")
    return best.select(F.col("grp").alias(group), F.col("id").alias(key), "neighbour", "cosine")


_VISITS = _PROJECTED + ", home boolean"


def _sent(trees: dict[tuple[str, int], TopTree], m: int, covered: float, one_way: bool):
    """Each row once for each block that it is sent to; `home` where it is its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            groups, dims = np.array(b.column(0).to_pylist(), object), b.column(1).to_numpy(zero_copy_only=False)
            for g, dim in {(g, int(d)) for g, d in zip(groups, dims, strict=True)}:
                rows = b.filter(pa.array((groups == g) & (dims == dim)))
                n = rows.num_rows
                at, block = np.arange(n), np.zeros(n, np.int64)
                if (g, dim) in trees:
                    points = np.frombuffer(b"".join(rows.column(6).to_pylist()), np.float32).reshape(n, m).astype(np.float64)
                    at, block = trees[g, dim].visits(points, rows.column(7).to_numpy(zero_copy_only=False), covered)
                home = np.arange(len(at)) < n
                if one_way:
                    keep = home | rows.column(3).to_numpy(zero_copy_only=False)[at]
                    at, block, home = at[keep], block[keep], home[keep]
                sent = rows.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*(sent.column(k) for k in range(4)), pa.array(block, pa.int64()), sent.column(5), sent.column(6), pa.array(home)], names=[f.split()[0] for f in _VISITS.split(", ")])

    return run


def _searched(visits: DataFrame, aim: dict[tuple[str, int], int], k: int, chi: float, floor: float | None, m: int, one_way: bool) -> DataFrame:
    """Hits of the rows at home in a block among themselves and with those that are sent to it.

    A task holds one part of a block's own rows and one of the rows sent to it, of bounded size: parts of own rows are sent to each other.
    """
    spark = visits.sparkSession
    sizes = visits.groupBy("grp", "dim", "block").agg(F.count_if("home").alias("own"), F.count_if(~F.col("home")).alias("others")).collect()
    plan = []
    for r in sizes:
        parts = max(1, round(r.own / aim[r.grp, r.dim] / 2))
        others = r.others + (r.own * (parts - 1) // parts)
        plan.append((r.grp, r.dim, r.block, parts, max(1, -(-others // (VISITORS * aim[r.grp, r.dim])))))
    # one row a block: at most BLOCKS of each group and dimension
    plan_df = F.broadcast(spark.createDataFrame(plan, "grp string, dim int, block bigint, parts bigint, chunks bigint"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    placed = visits.join(plan_df, ["grp", "dim", "block"]).withColumn("own_part", part).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    placed = placed.withColumn("resident", F.col("home") & (F.col("part") == F.col("own_part")))
    if one_way:
        placed = placed.where("resident OR query")
    mine = F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)
    placed = placed.withColumn("chunk", F.explode(F.when(F.col("resident"), mine).otherwise(F.array(F.pmod(F.xxhash64("id", F.lit(7)), F.col("chunks"))))))
    task = placed.select(F.xxhash64("grp", "dim", "block", "part", "chunk").alias("task"), "grp", "dim", "block", "part", "chunk", "id", "query", "v", "p", F.when(F.col("resident"), 0).otherwise(1).alias("side"))
    n_tasks = sum(p * c for *_, p, c in plan)
    return task.repartition(max(1, min(n_tasks, 20_000)), "task").groupBy("grp", "dim", "block", "part", "chunk", "task").applyInArrow(_search_task(k, chi, floor, m, one_way), "grp string, id string, neighbour string, cosine double")


def _first(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("grp", "id").orderBy(F.desc("cosine"), "neighbour")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def _with_copies(best: DataFrame, members: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """From representatives to all keys. The k + 1 smallest copies of a vector are all that anyone's neighbours can name."""
    order = Window.partitionBy("grp", "rep").orderBy("id")
    heads = members.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1).groupBy("grp", "rep").agg(F.array_sort(F.collect_list("id")).alias("heads"), F.max("n").alias("n"))
    heads = scratch.save(heads)
    of = heads.select(F.col("grp").alias("g2"), F.col("rep").alias("r2"), F.col("heads").alias("h2"), F.col("n").alias("n2"))
    others = best.join(of, (F.col("grp") == F.col("g2")) & (F.col("neighbour") == F.col("r2")), "left")
    others = others.select("grp", "id", F.explode(F.slice(F.coalesce("h2", F.array("neighbour")), 1, k)).alias("neighbour"), "cosine")
    others = others.join(of, (F.col("grp") == F.col("g2")) & (F.col("id") == F.col("r2")), "left").where(F.coalesce("n2", F.lit(1)) <= k)
    others = others.select("grp", F.explode(F.coalesce("h2", F.array("id"))).alias("id"), "neighbour", "cosine")
    own = lookup_join(members.select("grp", "rep", "id"), heads.select("grp", "rep", "heads"), ["grp", "rep"], "id", how="inner")
    own = own.select("grp", "id", F.explode("heads").alias("neighbour"), F.lit(1.0).alias("cosine")).where("id <> neighbour")
    return _first(others.unionByName(own), k)


def _bytes(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, width)


def _search_task(k: int, chi: float, floor: float | None, m: int, one_way: bool):
    def run(part: pa.Table) -> pa.Table:
        dim = part["dim"][0].as_py()
        v = _bytes(part["v"], dim).astype(np.float64)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        p = _bytes(part["p"], m)
        ids = np.array(part["id"].to_pylist(), object)
        # ids in order, so that equal cosines go by the smaller one
        order = np.argsort(ids)
        v, p, ids, side, asks = v[order], p[order], ids[order], part["side"].to_numpy()[order], np.array(part["query"].to_pylist(), bool)[order]
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        hits = []
        alone = part["chunk"][0].as_py() == 0  # own rows among themselves once
        if one_way:
            q = np.flatnonzero(asks & (side == 0))
            if alone and len(q):
                a, b, c = search(v[q], p[q], v[one], p[one], k, chi, floor, np.searchsorted(one, q))
                hits.append((q[a], one[b], c))
            if len(one) and len(two):
                a, b, c = search(v[two], p[two], v[one], p[one], k, chi, floor)
                hits.append((two[a], one[b], c))
        else:
            if alone and len(one):
                ((a, b, c),) = search_both(v[one], p[one], v[one], p[one], k, chi, floor, True)
                hits.append((one[a], one[b], c))
            if len(one) and len(two):
                (a, b, c), (x, y, z) = search_both(v[one], p[one], v[two], p[two], k, chi, floor, False)
                hits += [(one[a], two[b], c), (two[x], one[y], z)]
        a, b, c = (np.concatenate(x) for x in zip(*hits, strict=True)) if hits else (np.empty(0, int), np.empty(0, int), np.empty(0))
        return pa.table({"grp": pa.array([part["grp"][0].as_py()] * len(c), pa.string()), "id": pa.array(ids[a].tolist(), pa.string()), "neighbour": pa.array(ids[b].tolist(), pa.string()), "cosine": pa.array(c, pa.float64())})

    return run
