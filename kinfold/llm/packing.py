"""Filling containers of fixed capacity: dominance reduction on the histogram of sizes, then best fit."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.tokens import VOCABULARY, with_sizes
from kinfold.operators.skew import ranked
from kinfold.scratch import Scratch


@dataclass
class Pattern:
    """`count` containers, each with the same sizes."""

    sizes: list[int]
    count: int


class _Stock:
    """Items left, by size."""

    def __init__(self, histogram: dict[int, int]):
        self.left = {s: n for s, n in histogram.items() if n > 0}
        self.sizes = sorted(self.left)

    def take(self, size: int, n: int) -> None:
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def largest_upto(self, room: int) -> int | None:
        k = bisect_right(self.sizes, room)
        return self.sizes[k - 1] if k else None

    def smallest(self, n: int, but: int) -> list[int]:
        """The n smallest items, without one item of the size `but`."""
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(self.left[s] - (s == but), n - len(out))
            if len(out) == n:
                break
        return out


def reduce_by_dominance(stock: _Stock, capacity: int) -> list[Pattern]:
    """Fixes containers that are part of some best packing (Martello and Toth's dominance), in bulk over equal sizes.

    For the largest item x: a partner of exactly the room left dominates all other sets with x; if no item fits beside x
    it stays alone; if the two smallest others do not fit together beside x, at most one item can join it and the
    largest that fits dominates. If at most two can join it, let a >= b be the two that fill the room best: the largest single partner
    dominates if it is as large as both together; the two dominate if a is as large as that partner and no two items
    between them and b fit. Where none of these holds the item is left for best fit, as are all smaller ones that have no such set.
    """
    fixed: list[Pattern] = []

    def fix(sizes: list[int]) -> None:
        # in bulk while the condition holds for each: the smallest others only grow as items go
        m = min(stock.left[s] // sizes.count(s) for s in sizes)
        fixed.append(Pattern(sizes, m))
        for s in sorted(set(sizes)):
            stock.take(s, m * sizes.count(s))

    for x in sorted(stock.sizes, reverse=True):
        while n := stock.left.get(x, 0):
            room = capacity - x
            y = stock.largest_upto(room)
            if y == x and n == 1:  # the item itself is no partner
                k = bisect_left(stock.sizes, x)
                y = stock.sizes[k - 1] if k else None
            if y is None:
                fix([x])
                continue
            small = stock.smallest(3, x)
            if y == room or len(small) < 2 or sum(small[:2]) > room:
                fix([x, y])
                continue
            if len(small) == 3 and sum(small) <= room:
                break  # four or more may fit: not decided here
            a, b = _best_two(stock, x, room)
            if y >= a + b:
                fix([x, y])
            elif y == a and not _two_between(stock, x, b, a, room):
                fix([x, a, b])
            else:
                break
    return fixed


def _others(stock: _Stock, x: int) -> list[tuple[int, int]]:
    """(size, number) of all items but one of the size x, the smallest first."""
    return [(s, stock.left[s] - (s == x)) for s in stock.sizes if stock.left[s] > (s == x)]


def _best_two(stock: _Stock, x: int, room: int) -> tuple[int, int]:
    """The two others that fill the room best, the larger one first; of equal sums those with the largest item."""
    others = _others(stock, x)
    i, j, best = 0, len(others) - 1, (0, 0, 0)
    while i <= j:
        (b, _), (a, n) = others[i], others[j]
        if a + b > room or (i == j and n < 2):
            j -= 1
            continue
        best = max(best, (a + b, a, b))
        i += 1
    return best[1:]


def _two_between(stock: _Stock, x: int, b: int, a: int, room: int) -> bool:
    """Whether two others, each larger than b and smaller than a, fit together."""
    between = [s for s, n in _others(stock, x) if b < s < a for _ in range(min(n, 2))][:2]
    return len(between) == 2 and sum(between) <= room


def best_fit(stock: _Stock, capacity: int) -> list[Pattern]:
    """Best fit decreasing over the rest: each item goes to the fullest container with room, in bulk over equal sizes."""
    by_room: dict[int, list[Pattern]] = {}
    rooms: list[int] = []

    def put(p: Pattern, room: int) -> None:
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append(p)

    for x in sorted(stock.sizes, reverse=True):
        n = stock.left[x]
        while n:
            k = bisect_left(rooms, x)
            if k == len(rooms):
                # new containers: what one holds of x is filled at once only if nothing else would come before
                each = min(n, capacity // x)
                m = n // each
                put(Pattern([x] * each, m), capacity - x * each)
                n -= m * each
                continue
            room = rooms[k]
            group = by_room[room]
            p = group.pop()
            if not group:
                del by_room[room]
                rooms.pop(k)
            each = min(n, room // x)
            m = min(p.count, n // each)
            if m < p.count:
                put(Pattern(p.sizes, p.count - m), room)
            put(Pattern(p.sizes + [x] * each, m), room - x * each)
            n -= m * each
    stock.left, stock.sizes = {}, []
    return [p for group in by_room.values() for p in group]


def plan(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Containers for the items; the instance has at most `capacity` sizes, whatever the number of items."""
    fixed, rest = plan_parts(histogram, capacity)
    return fixed + rest


def plan_parts(histogram: dict[int, int], capacity: int) -> tuple[list[Pattern], list[Pattern]]:
    """What dominance fixed, and best fit for the rest."""
    stock = _Stock(histogram)
    return reduce_by_dominance(stock, capacity), best_fit(stock, capacity)


def _slots(patterns: list[Pattern], first: int) -> dict[str, np.ndarray]:
    """For each pattern and size: ranks [start, end) of that size go to containers from `base` on, `each` to a container, from place `place` on."""
    rows, used, base = [], {}, first
    for p in patterns:
        place = 0
        for size in sorted(set(p.sizes), reverse=True):
            each = p.sizes.count(size)
            start = used.get(size, 0)
            rows.append((size, start, base, each, place))
            used[size] = start + each * p.count
            place += each
        base += p.count
    rows.sort()
    return {k: np.array(c, np.int64) for k, c in zip(("size", "start", "base", "each", "place"), zip(*rows, strict=True), strict=True)} if rows else {}


def pack(documents: DataFrame, capacity: int, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, piece_no, first_token, n_tokens, container_id, place, fixed): every document, or piece of one, in its container; `fixed` if dominance decided it.

    Only a text of more than `capacity` tokens is split, into pieces of `capacity` tokens and a rest. Full pieces have a
    container of their own; all other items are packed together. A document without tokens takes no room: it comes out
    once with null container_id and place. Keys must be distinct; an empty table gives an empty result.

    Sizes are counted first; what is packed on the driver is the histogram, of at most `capacity` rows, and the plan made
    of it. Documents find their container by their rank among those of the same size.
    """
    scratch = Scratch(documents.sparkSession, "packing")
    sized = scratch.save(with_sizes(documents, [key], text, "__all", vocabulary))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("__all") / capacity)).cast("bigint")
    items = sized.select(key, "__all", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)).alias("piece_no"))
    items = items.select(key, "piece_no", (F.col("piece_no") * capacity).alias("first_token"), F.least(F.lit(capacity), F.col("__all") - F.col("piece_no") * capacity).alias("n_tokens"))
    histogram = {r[0]: r[1] for r in items.groupBy("n_tokens").count().collect()}  # at most capacity + 1 rows
    empty = histogram.pop(0, 0)
    fixed, rest = plan_parts(histogram, capacity)
    patterns, fixed_below = fixed + rest, sum(p.count for p in fixed)
    slots = _slots(patterns, 0)
    if not slots:
        return items.select("*", F.lit(None).cast("bigint").alias("container_id"), F.lit(None).cast("bigint").alias("place"), F.lit(None).cast("boolean").alias("fixed"))
    low = slots["size"] << 40
    starts = low + slots["start"]

    @F.pandas_udf("container_id bigint, place bigint")
    def find(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(starts, (size.to_numpy(np.int64) << 40) + rank.to_numpy(np.int64), "right") - 1
        along = rank.to_numpy(np.int64) - slots["start"][at]
        each = slots["each"][at]
        return pd.DataFrame({"container_id": slots["base"][at] + along // each, "place": slots["place"][at] + along % each})

    n = sum(histogram.values()) + empty
    placed = ranked(items, ["n_tokens"], [key, "piece_no"], "__rank", total=n).withColumn("__at", find("n_tokens", "__rank"))
    some = F.col("n_tokens") > 0
    return placed.select(key, "piece_no", "first_token", "n_tokens", F.when(some, F.col("__at.container_id")).alias("container_id"), F.when(some, F.col("__at.place")).alias("place"), F.when(some, F.col("__at.container_id") < fixed_below).alias("fixed"))


def container_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, items and those that dominance fixed, tokens, share of the room that is used, and the least possible number of containers."""
    per = packed.where(F.col("container_id").isNotNull()).groupBy("container_id").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("items"), F.count_if("fixed").alias("fixed"))
    return per.agg(
        F.count(F.lit(1)).alias("containers"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("items"),
        F.coalesce(F.sum("fixed"), F.lit(0)).alias("fixed_items"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        F.coalesce(F.max("tokens"), F.lit(0)).alias("fullest"),
        F.round(F.coalesce(F.sum("tokens") / (F.count(F.lit(1)) * capacity), F.lit(0.0)), 6).alias("used_share"),
        F.coalesce(F.ceil(F.sum("tokens") / capacity), F.lit(0)).alias("lower_bound"),
    )
