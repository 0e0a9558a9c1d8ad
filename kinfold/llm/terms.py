"""Frequency of every distinct term: burst tries per partition, routed by adaptive prefixes, merged by matching subtrees."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.scratch import Scratch

_TERM = re.compile(r"[^\W_]+")
#: A container of a trie bursts into one container per next letter beyond so many terms.
BURST = 2048
#: Prefixes with at least 1/ROUTES of all partial counters are routed a letter deeper, so at most ROUTES of each length are.
ROUTES = 4096
_DEEPEST = 24

_PARTIAL = "grp string, prefix string, burst boolean, terms array<string>, occurrences array<bigint>, records array<bigint>"


class BurstTrie:
    """Counters by term. An inner node is a dict of children by letter; a container is a dict of the rest of the term to [occurrences, records]."""

    __slots__ = ("root", "burst")

    def __init__(self, burst: int = BURST):
        self.root: _Node | _Container = _Container()
        self.burst = burst

    def add(self, term: str, occurrences: int, records: int) -> None:
        parent, node, at = None, self.root, 0
        while type(node) is _Node:
            letter = term[at : at + 1]
            parent, child = node, node.get(letter)
            if child is None:
                child = node[letter] = _Container()
            node, at = child, at + 1
        rest = term[at:]
        counter = node.get(rest)
        if counter is None:
            node[rest] = [occurrences, records]
            if len(node) > self.burst and at < _DEEPEST:
                split = _Node()
                for suffix, c in node.items():
                    split.setdefault(suffix[:1], _Container())[suffix[1:]] = c
                if parent is None:
                    self.root = split
                else:
                    parent[term[at - 1 : at]] = split
        else:
            counter[0] += occurrences
            counter[1] += records

    def containers(self) -> Iterator[tuple[str, dict[str, list[int]]]]:
        """(prefix, container) in no order; the prefix is that of all its terms."""
        todo = [("", self.root)]
        while todo:
            prefix, node = todo.pop()
            if type(node) is _Node:
                todo.extend((prefix + letter, child) for letter, child in node.items())
            elif node:
                yield prefix, node

    def burst_prefixes(self) -> Iterator[str]:
        todo = [("", self.root)]
        while todo:
            prefix, node = todo.pop()
            if type(node) is _Node:
                yield prefix
                todo.extend((prefix + letter, child) for letter, child in node.items())


class _Node(dict):
    __slots__ = ()


class _Container(dict):
    __slots__ = ()


def _batch(rows: list[tuple], burst: bool) -> pa.RecordBatch:
    g, p, t, o, r = zip(*rows, strict=True)
    many = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(p, pa.string()), pa.array([burst] * len(g)), pa.array(t, pa.list_(pa.string())), pa.array(o, many), pa.array(r, many)], names=["grp", "prefix", "burst", "terms", "occurrences", "records"])


def _emit(tries: dict[str, BurstTrie]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    for g, trie in tries.items():
        for prefix, c in trie.containers():
            rows.append((g, prefix, list(c), [x[0] for x in c.values()], [x[1] for x in c.values()]))
            size += len(c)
            if size > 20_000:
                yield _batch(rows, False)
                rows, size = [], 0
    if rows:
        yield _batch(rows, False)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tries: dict[str, BurstTrie] = {}
    held = 0
    for b in batches:
        # counted by batch first, so that a frequent term goes down the trie once for each batch
        seen: dict[tuple[str, str], list[int]] = {}
        for g, value, frequency, records in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            terms = _TERM.findall(value.lower())
            for term in terms:
                c = seen.get((g, term))
                if c is None:
                    seen[g, term] = [frequency, 0]
                else:
                    c[0] += frequency
            if records:
                for term in set(terms):
                    seen[g, term][1] += records
        for (g, term), (o, r) in seen.items():
            (tries.get(g) or tries.setdefault(g, BurstTrie())).add(term, o, r)
        held += len(seen)
        if held > 500_000:  # a worker's tries stay small; parts of the same subtree are merged later
            yield from _emit(tries)
            yield from _burst_rows(tries)
            tries, held = {}, 0
    yield from _emit(tries)
    yield from _burst_rows(tries)


def _burst_rows(tries: dict[str, BurstTrie]) -> Iterator[pa.RecordBatch]:
    rows = [(g, p, [], [], []) for g, t in tries.items() for p in t.burst_prefixes()]
    if rows:
        yield _batch(rows, True)


def _router(routes: dict[str, set[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for g, p, t, o, r in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4, 5)), strict=True):
                deep = routes.get(g, set())
                parts: dict[str, tuple[list, list, list]] = {}
                for suffix, x, y in zip(t, o, r, strict=True):
                    term, k = p + suffix, 0
                    while term[:k] in deep and k < len(term):
                        k += 1
                    part = parts.setdefault(term[:k], ([], [], []))
                    part[0].append(term[k:])
                    part[1].append(x)
                    part[2].append(y)
                rows += [(g, q, *part) for q, part in parts.items()]
            if rows:
                yield _batch(rows, False)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counters come in the order of their subtree, so one subtree is held at a time."""

    def counted(key: tuple[str, str], subtree: BurstTrie) -> Iterator[pa.RecordBatch]:
        g, p = key
        for prefix, c in subtree.containers():
            n = len(c)
            yield pa.RecordBatch.from_arrays([pa.array([g] * n, pa.string()), pa.array([p + prefix + s for s in c], pa.string()), pa.array([x[0] for x in c.values()], pa.int64()), pa.array([x[1] for x in c.values()], pa.int64())], names=["grp", "term", "occurrences", "records"])

    key, subtree = None, BurstTrie()
    for b in batches:
        for g, p, t, o, r in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4, 5)), strict=True):
            if key != (g, p):
                if key is not None:
                    yield from counted(key, subtree)
                key, subtree = (g, p), BurstTrie()
            for suffix, x, y in zip(t, o, r, strict=True):
                subtree.add(suffix, x, y)
    if key is not None:
        yield from counted(key, subtree)


def term_counts(values: DataFrame, group: str, value: str, frequency: str, records: str) -> DataFrame:
    """(group, term, occurrences, records): for every distinct term of each group, how often it occurs and how many records hold it.

    A term is a longest run of letters and digits of the lower-cased value. Each row of `values` stands for `frequency`
    occurrences of the value and `records` records that hold it. Null values have no term, null numbers count as 0.
    """
    scratch = Scratch(values.sparkSession, "terms")
    rows = values.where(F.col(value).isNotNull() & F.col(group).isNotNull()).select(F.col(group).alias("grp"), F.col(value).alias("value"), F.coalesce(F.col(frequency).cast("bigint"), F.lit(0)).alias("f"), F.coalesce(F.col(records).cast("bigint"), F.lit(0)).alias("r"))
    partial = scratch.save(rows.mapInArrow(_count, _PARTIAL))
    sizes = partial.where("NOT burst").select("grp", F.size("terms").alias("n"), "prefix")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # every burst node is a prefix of many terms; those of the heaviest are routed deeper
    heavy = partial.where("burst").select("grp", "prefix").distinct()
    spread = sizes.select("grp", "n", F.explode(F.sequence(F.lit(0), F.least(F.length("prefix"), F.lit(_DEEPEST)))).alias("k"), "prefix").groupBy("grp", F.substring("prefix", F.lit(1), F.col("k")).alias("prefix")).agg(F.sum("n").alias("n"))
    routes: dict[str, set[str]] = {}
    for g, p in spread.where(F.col("n") >= max(BURST, total / ROUTES)).join(heavy, ["grp", "prefix"], "left_semi").select("grp", "prefix").collect():
        routes.setdefault(g, set()).add(p)
    routed = partial.where("NOT burst").mapInArrow(_router(routes), _PARTIAL)
    counted = routed.repartition("grp", "prefix").sortWithinPartitions("grp", "prefix").mapInArrow(_merge, "grp string, term string, occurrences bigint, records bigint")
    return counted.select(F.col("grp").alias(group), "term", "occurrences", "records")


def banded(counts: DataFrame, totals: DataFrame, group: str, common_share: float = 0.1) -> DataFrame:
    """Adds `band`: rare (one record), common (at least `common_share` of the group's records), else usable. `totals` has a row (group, total) for each group, a handful by the schema."""
    return counts.join(F.broadcast(totals), group, "left").withColumn("band", F.when(F.col("records") == 1, "rare").when(F.col("records") >= F.col("total") * common_share, "common").otherwise("usable"))
