"""Groups of records linked by pairwise matches: the giant component is peeled off by breadth-first joins, the rest is labelled by minimum propagation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.graph import _both_ways, hashed_vertices, min_propagation, undirected
from kinfold.operators.skew import lookup_join
from kinfold.scratch import Scratch

#: Steps of the breadth-first peel at most. Giant components of match graphs are a few steps wide; a long chain costs each of its steps a join.
PEEL_ROUNDS = 24
_SPACE = r"[\s\p{Z}\x{FEFF}]+"


def clean_id(c: Column) -> Column:
    """The id without surrounding white space of any kind; an empty id is null."""
    return F.nullif(F.regexp_replace(c, f"^{_SPACE}|{_SPACE}$", ""), F.lit(""))


def _peel(edges: DataFrame, scratch: Scratch, rounds: int) -> tuple[DataFrame | None, DataFrame]:
    """(visited (a, root) or None, edges that are left).

    Starts at the vertex of the highest degree and follows the frontier to its end, for `rounds` steps at most. What is
    left of a longer component after that stays connected: its edges to visited vertices come out as edges to
    the start, and minimum propagation follows it in fewer rounds than steps.
    """
    ends = _both_ways(edges)
    first = ends.groupBy("a").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "a").limit(1).collect()
    if not first:
        return None, edges
    start = first[0]["a"]
    spark = edges.sparkSession
    frontier = spark.createDataFrame([(start,)], "a long")
    visited, tail = frontier, None
    layers = [frontier]
    for step in range(rounds):
        reached = ends.join(frontier, "a", "left_semi").select(F.col("b").alias("a")).distinct()
        for layer in layers[-2:]:  # neighbours of a layer lie in it, the one before and the next
            reached = reached.join(layer, "a", "left_anti")
        reached, new = scratch.save_counted(reached)
        tail = reached if new and step == rounds - 1 else None
        if not new or tail is not None:
            break
        layers.append(reached)
        visited = visited.unionByName(reached)
        frontier = reached
    visited = scratch.save(visited)
    rest = edges.join(visited.select(F.col("a").alias("u")), "u", "left_anti").join(visited.select(F.col("a").alias("v")), "v", "left_anti")
    if tail is not None:
        rest = rest.select("u", "v").unionByName(undirected(tail.select(F.lit(start).alias("s"), "a"), "s", "a"))
    return visited.select("a", F.lit(start).alias("root")), scratch.save(rest.select("u", "v"))


def match_groups(pairs: DataFrame, left: str = "record1_id", right: str = "record2_id", rounds: int = PEEL_ROUNDS) -> DataFrame:
    """(record_id, group_id, group_size): every record of a pair with both ids, and the smallest record id reachable from it.

    Ids are compared without surrounding white space; a row where either id is null or empty is no match and is ignored.
    Either order of a pair, repeated pairs and self-pairs are allowed; a record paired only with itself is a group of
    its own. An empty table gives an empty result. Other columns of `pairs` are ignored, whatever their names.
    """
    scratch = Scratch(pairs.sparkSession, "match-groups")
    pairs = pairs.select(clean_id(F.col(left)).alias("a"), clean_id(F.col(right)).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    vertices, seed = hashed_vertices(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id", scratch)
    edges = scratch.save(undirected(pairs.select(F.xxhash64("a", F.lit(seed)).alias("a"), F.xxhash64("b", F.lit(seed)).alias("b")), "a", "b"))
    visited, rest = _peel(edges, scratch, rounds)
    roots = min_propagation(rest, scratch)
    if visited is not None:
        # the start may have been given another root through the tail
        start = roots.select(F.col("a").alias("root"), F.col("root").alias("final"))
        peeled = visited.join(F.broadcast(start.join(F.broadcast(visited.select("root").limit(1)), "root", "left_semi")), "root", "left").select("a", F.coalesce("final", "root").alias("root"))
        roots = roots.join(visited.select("a"), "a", "left_anti").unionByName(peeled)
    rooted = scratch.save(vertices.join(roots.withColumnRenamed("a", "v"), "v", "left").select(F.col("id").alias("record_id"), F.coalesce("root", "v").alias("root")))
    groups = rooted.groupBy("root").agg(F.min("record_id").alias("group_id"), F.count(F.lit(1)).alias("group_size"))
    return lookup_join(rooted, groups, ["root"], "record_id").select("record_id", "group_id", "group_size")
