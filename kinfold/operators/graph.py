"""Connected components by minimum propagation with contraction (used by every graph operator of the package)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.scratch import Scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))).alias("e")).select("e.a", "e.b")


def undirected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct edges (u < v) without loops."""
    return edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()


def min_propagation(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, root) for every vertex of the edges (u < v, of longs that are spread at random, such as hashes).

    Each round gives a vertex the smallest id among itself and its neighbours, then replaces vertices by what they were
    given and drops loops and repeated edges. As ids are in no order along a path, a constant share of the vertices
    of any path goes in each round, so long chains need rounds in the logarithm of their length. Rounds' results are
    put together at the end, from the smallest on.
    """
    maps: list[DataFrame] = []
    current, own, left = edges, False, edges.limit(1).count()
    while left:
        smallest = _both_ways(current).groupBy("a").agg(F.min("b").alias("b"))
        step = scratch.save(smallest.select("a", F.least("a", "b").alias("b")))
        maps.append(step)
        moved = current.join(step.select(F.col("a").alias("u"), F.col("b").alias("ru")), "u").join(step.select(F.col("a").alias("v"), F.col("b").alias("rv")), "v")
        following, left = scratch.save_counted(undirected(moved, "ru", "rv"))
        if own:
            scratch.drop(current)
        current, own = following, True
    if not maps:
        return edges.select(F.col("u").alias("a"), F.col("u").alias("root")).limit(0)
    root = maps[-1].select("a", F.col("b").alias("root"))
    for k, step in enumerate(reversed(maps[:-1])):
        later = root.select(F.col("a").alias("b"), F.col("root").alias("__later"))
        root = step.join(later, "b", "left").select("a", F.coalesce("__later", "b").alias("root"))
        if k % 6 == 5:  # keeps the plan short
            root = scratch.save(root)
    return root


def hashed_vertices(ids: DataFrame, column: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """(v long, id) for the distinct ids, and the seed with which xxhash64(id, seed) tells all of them apart."""
    for seed in range(32):
        out = scratch.save(ids.groupBy(F.xxhash64(F.col(column), F.lit(seed)).alias("v")).agg(F.min(column).alias("id"), F.max(column).alias("other")))
        if not out.where(F.col("id") != F.col("other")).limit(1).count():
            return out.select("v", "id"), seed
        scratch.drop(out)
    raise RuntimeError("no seed tells all ids apart")


def connected_components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): every id of a pair with the smallest id of its component.

    Pairs with a null id are ignored; a pair of an id with itself makes a component of its own; an empty table gives an
    empty result.
    """
    from kinfold.operators.skew import lookup_join

    scratch = Scratch(pairs.sparkSession, "components")
    pairs = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"))
    vertices, seed = hashed_vertices(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id", scratch)
    edges = scratch.save(undirected(pairs.select(F.xxhash64("a", F.lit(seed)).alias("a"), F.xxhash64("b", F.lit(seed)).alias("b")), "a", "b"))
    roots = min_propagation(edges, scratch)
    rooted = vertices.join(roots, vertices.v == roots.a, "left").select("id", F.coalesce("root", "v").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("id").alias("component"))
    return lookup_join(rooted, smallest, ["root"], "id").select("id", "component")


def build_edges(pairs: DataFrame, a: str, b: str, weight: str, least: float = 0.0) -> DataFrame:
    """(src, dst, weight), src < dst: the best weight of each pair, at least `least`. Pairs with a null id or weight, and loops, are no edges."""
    rows = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)) & (F.col(weight) >= least))
    return rows.groupBy(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")).agg(F.max(weight).alias("weight"))


def symmetric(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("other"), "weight"), F.struct(F.col("dst").alias("node"), F.col("src").alias("other"), "weight"))).alias("e")).select("e.*")


def transitive_edges(edges: DataFrame, least: float = 0.5) -> DataFrame:
    """Edges that close an open wedge: the best product of the two weights, at least `least`. One pass; existing edges are left out.

    Weights are at most 1, so an edge below `least` closes nothing: it does not reach the self-join.
    """
    near = symmetric(edges.where(F.col("weight") >= least))
    x, y = near.alias("x"), near.alias("y")
    wedges = x.join(y, (F.col("x.node") == F.col("y.node")) & (F.col("x.other") < F.col("y.other"))).where(F.col("x.weight") * F.col("y.weight") >= least)
    closed = wedges.groupBy(F.col("x.other").alias("src"), F.col("y.other").alias("dst")).agg(F.max(F.col("x.weight") * F.col("y.weight")).alias("weight"))
    return closed.join(edges.select("src", "dst"), ["src", "dst"], "left_anti")


def split_oversize(clusters: DataFrame, edges: DataFrame, most: int, connectivity: float) -> DataFrame:
    """(id, component): clusters above `most` members fall apart along edges below `connectivity`; one that would not, or others, stay as they are."""
    from kinfold.operators.skew import lookup_join

    large = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("component", F.lit(True).alias("__large"))
    marked = lookup_join(clusters, large, ["component"], "id")
    members = marked.where("__large").select("id", "component")
    inside = edges.where(F.col("weight") >= connectivity).join(members.select(F.col("id").alias("src")), "src", "left_semi")
    parts = connected_components(inside, "src", "dst").withColumnRenamed("component", "part")
    split = members.join(parts, "id", "left").select("id", F.coalesce("part", "id").alias("component"))
    return marked.where("__large IS NULL").select("id", "component").unionByName(split)


def degrees(edges: DataFrame) -> DataFrame:
    return symmetric(edges).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def triangles(edges: DataFrame) -> DataFrame:
    """(node, triangles). Each edge points from the lower degree to the higher, so no node has many more than sqrt(2 m) outgoing ones and a hub's wedges are never listed."""
    d = degrees(edges)
    of = lambda c: d.select(F.col("node").alias(c), F.col("degree").alias(f"{c}_degree"))
    both = edges.select("src", "dst").join(of("src"), "src").join(of("dst"), "dst")
    first = F.struct("src_degree", "src") < F.struct(F.col("dst_degree").alias("src_degree"), F.col("dst").alias("src"))
    out = both.select(F.when(first, F.col("src")).otherwise(F.col("dst")).alias("a"), F.when(first, F.col("dst")).otherwise(F.col("src")).alias("b"))
    x, y = out.alias("x"), out.alias("y")
    wedges = x.join(y, (F.col("x.a") == F.col("y.a")) & (F.col("x.b") < F.col("y.b"))).select(F.col("x.a").alias("a"), F.col("x.b").alias("src"), F.col("y.b").alias("dst"))
    closed = wedges.join(edges.select("src", "dst"), ["src", "dst"], "left_semi")
    return closed.select(F.explode(F.array("a", "src", "dst")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("triangles"))


def graph_statistics(edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, density, average degree, average clustering coefficient over all nodes, components."""
    d = degrees(edges).join(triangles(edges), "node", "left")
    local = F.when(F.col("degree") > 1, 2 * F.coalesce("triangles", F.lit(0)) / (F.col("degree") * (F.col("degree") - 1))).otherwise(0.0)
    stats = d.agg(F.count(F.lit(1)).alias("nodes"), (F.sum("degree") / 2).cast("bigint").alias("edges"), F.avg(local).alias("average_clustering"))
    groups = connected_components(edges, "src", "dst").agg(F.count_distinct("component").alias("components"))
    n, m = F.col("nodes"), F.col("edges")
    return stats.crossJoin(F.broadcast(groups)).select("nodes", "edges", "components", F.coalesce(F.try_divide(2 * m, n * (n - 1)), F.lit(0.0)).alias("density"), F.coalesce(F.try_divide(2 * m, n), F.lit(0.0)).alias("average_degree"), F.coalesce("average_clustering", F.lit(0.0)).alias("average_clustering"))


def label_propagation(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(id, label): each round a node takes the most frequent label of its neighbours, its own if that is one of them, else the smallest of equals, until nothing changes.

    Nodes take turns by a hash of the id and the round, half of them each time, so that neighbours do not swap labels for ever.
    Labels that have not settled after `rounds` are an error, not a result.
    """
    scratch = Scratch(edges.sparkSession, "label-propagation")
    near = scratch.save(symmetric(edges).select("node", "other"))
    labels = scratch.save(near.select(F.col("node").alias("id"), F.col("node").alias("label")).distinct())
    for r in range(2 * rounds):
        votes = near.join(labels.withColumnRenamed("id", "other"), "other").groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
        own = votes.join(labels.toDF("node", "own"), "node")
        best = own.groupBy("node").agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("new"), F.max("n").alias("n"), F.max(F.when(F.col("label") == F.col("own"), F.col("n"))).alias("same"))
        # wants to move where another label is more frequent than its own
        wanted = best.where(F.col("n") > F.coalesce("same", F.lit(0))).select(F.col("node").alias("id"), "new")
        turn = F.pmod(F.xxhash64("id", F.lit(r)), F.lit(2)) == 0
        moved = scratch.save(labels.join(wanted, "id", "left").select("id", F.when(turn & F.col("new").isNotNull(), F.col("new")).otherwise(F.col("label")).alias("label"), F.col("new").isNotNull().alias("unsettled")))
        unsettled = moved.where("unsettled").limit(1).count()
        scratch.drop(labels)
        labels = moved.select("id", "label")
        labels._scratch_path = moved._scratch_path
        if not unsettled:
            return labels
    raise RuntimeError(f"labels have not settled after {rounds} rounds")


def _by_component(edges: DataFrame) -> DataFrame:
    groups = connected_components(edges, "src", "dst")
    return edges.join(groups.withColumnRenamed("id", "src"), "src")


def louvain(edges: DataFrame, least_gain: float = 1e-9) -> DataFrame:
    """(id, community): modularity communities within each component; the community is named by its smallest id.

    Local moves are joins: every node sees the weight of its edges into each neighbouring community and takes the one with the highest
    gain in modularity of its component, the smallest of equals. Nodes take turns by a hash, half of them each time; moves go on
    while they raise the modularity. Then communities become nodes, until none moves. All components get the same
    treatment whatever their size; none is collected.
    """
    scratch = Scratch(edges.sparkSession, "louvain")
    placed = scratch.save(_by_component(edges))
    # twice the weight of each component, for every node of it
    totals = placed.groupBy("component").agg((2 * F.sum("weight")).alias("total"))
    ends = placed.select("component", F.explode(F.array("src", "dst")).alias("id")).distinct()
    members = scratch.save(ends.join(totals, "component").select("id", F.col("id").alias("node"), "total"))
    links = scratch.save(placed.select(F.explode(F.array(F.struct(F.col("src").alias("a"), F.col("dst").alias("b")), F.struct(F.col("dst").alias("a"), F.col("src").alias("b")))).alias("e"), "weight").select("e.*", "weight"))
    while True:
        nodes = members.groupBy("node").agg(F.first("total").alias("total"))
        strength = links.groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("strength"))
        start = scratch.save(nodes.join(strength, "node").select("node", "strength", "total", F.col("node").alias("community")))
        moved = _moved(start, links, least_gain, scratch)
        if moved is None:
            break
        names = scratch.save(members.join(moved.select("node", "community"), "node").select("id", F.col("community").alias("node"), "total"))
        of = moved.select("node", "community")
        merged = links.join(of.toDF("a", "ca"), "a").join(of.toDF("b", "cb"), "b").groupBy(F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum("weight").alias("weight"))
        members, links = names, scratch.save(merged)
    least = members.groupBy("node").agg(F.min("id").alias("community"))
    return members.join(least, "node").select("id", "community")


def _moved(state: DataFrame, links: DataFrame, least_gain: float, scratch: Scratch) -> DataFrame | None:
    """The nodes' communities after local moves, None if no move raises the modularity."""
    best, before, quiet, turn = None, _modularity(state, links), 0, 0
    while quiet < 2:
        weights = state.groupBy("community").agg(F.sum("strength").alias("all"))
        near = links.where("a <> b").join(state.select(F.col("node").alias("b"), "community"), "b").groupBy(F.col("a").alias("node"), "community").agg(F.sum("weight").alias("to"))
        offers = near.unionByName(state.select("node", "community", F.lit(0.0).alias("to"))).groupBy("node", "community").agg(F.sum("to").alias("to"))
        mine = state.select("node", "strength", "total", F.col("community").alias("own"))
        offers = offers.join(mine, "node").join(weights, "community")
        gain = F.round(F.col("to") - F.col("strength") * (F.col("all") - F.when(F.col("community") == F.col("own"), F.col("strength")).otherwise(0.0)) / F.col("total"), 12)
        offers = offers.withColumn("gain", gain)
        top = offers.groupBy("node").agg(F.max("gain").alias("top"), F.max(F.when(F.col("community") == F.col("own"), F.col("gain"))).alias("stay"))
        chosen = offers.join(top, "node").where("gain = top").groupBy("node").agg(F.min("community").alias("wanted"), F.first("top").alias("top"), F.first("stay").alias("stay"))
        goes = (F.col("top") > F.col("stay") + least_gain) & (F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0)
        following = state.join(chosen, "node").select("node", "strength", "total", F.when(goes, F.col("wanted")).otherwise(F.col("community")).alias("community"))
        following = scratch.save(following)
        after = _modularity(following, links)
        if after > before + least_gain:
            best, before, quiet = following, after, 0
        else:
            quiet += 1
        state, turn = following, turn + 1
    return best


def _modularity(state: DataFrame, links: DataFrame) -> float:
    """The sum of the components' modularities."""
    of = state.select("node", "community", "total")
    inner = links.join(of.toDF("a", "ca", "total"), "a").join(of.select(F.col("node").alias("b"), F.col("community").alias("cb")), "b").where("ca = cb").agg(F.sum(F.col("weight") / F.col("total")).alias("x"))
    spread = state.groupBy("community").agg((F.sum("strength") / F.first("total")).alias("share")).agg((-F.sum(F.col("share") * F.col("share"))).alias("x"))
    return inner.unionByName(spread).agg(F.sum("x")).first()[0] or 0.0


def hierarchical(edges: DataFrame, connectivity: float = 0.5, most_nodes: int = 1000) -> DataFrame:
    """(id, cluster): average linkage within each component, distance 1 - weight (1 where there is no edge), cut at 1 - connectivity.

    Components of two nodes pass through whole; those of more than `most_nodes` come out by `louvain`.
    """
    import numpy as np
    import pandas as pd

    scratch = Scratch(edges.sparkSession, "hierarchical")
    placed = scratch.save(_by_component(edges))
    sizes = placed.select("component", F.explode(F.array("src", "dst")).alias("id")).distinct().groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    large = scratch.save(sizes.where(F.col("n") > most_nodes).select("component"))

    def linkage(part: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(part.src) | set(part.dst))
        if len(names) <= 2:
            return pd.DataFrame({"id": names, "cluster": names[0]})
        index = {x: k for k, x in enumerate(names)}
        d = np.ones((len(names), len(names)))
        for a, b, w in zip(part.src, part.dst, part.weight, strict=True):
            d[index[a], index[b]] = d[index[b], index[a]] = 1 - w
        np.fill_diagonal(d, np.inf)
        groups = {k: [k] for k in range(len(names))}
        while len(groups) > 1:
            at = int(d.argmin())
            i, j = sorted(divmod(at, len(names)))
            if d[i, j] > 1 - connectivity:
                break
            ni, nj = len(groups[i]), len(groups[j])
            row = (ni * d[i] + nj * d[j]) / (ni + nj)
            row[[i, j]] = np.inf
            d[i], d[:, i] = row, row
            d[j], d[:, j] = np.inf, np.inf
            groups[i] += groups.pop(j)
        label = {k: names[min(g)] for g in groups.values() for k in g}
        return pd.DataFrame({"id": names, "cluster": [label[k] for k in range(len(names))]})

    out = placed.join(large, "component", "left_anti").groupBy("component").applyInPandas(linkage, "id string, cluster string")
    if large.limit(1).count():
        out = out.unionByName(louvain(placed.join(large, "component", "left_semi").select("src", "dst", "weight")).toDF("id", "cluster"))
    return out


def resolve_conflicts(memberships: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, cluster): an id of several clusters stays in the one to which its edges are heaviest on average, the smallest of equals; clusters without members vanish."""
    near = symmetric(edges).select(F.col("node").alias("id"), F.col("other").alias("member"), "weight")
    several = memberships.groupBy("id").agg(F.count_distinct("cluster").alias("n")).where("n > 1").select("id")
    pull = near.join(several, "id", "left_semi").join(memberships.toDF("member", "cluster"), "member").groupBy("id", "cluster").agg(F.avg("weight").alias("pull"))
    ranked = memberships.distinct().join(pull, ["id", "cluster"], "left").withColumn("pull", F.round(F.coalesce("pull", F.lit(0.0)), 12))
    top = ranked.groupBy("id").agg(F.max("pull").alias("pull"))
    return ranked.join(top, ["id", "pull"]).groupBy("id").agg(F.min("cluster").alias("cluster"))


def adjacency(edges: DataFrame) -> DataFrame:
    """(node, neighbours): a map of neighbour to weight, as an export of the whole graph; a node's list is one row."""
    return symmetric(edges).groupBy("node").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("other", "weight")))).alias("neighbours"))
