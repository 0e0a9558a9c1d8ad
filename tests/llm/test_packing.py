import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinfold.llm.packing import _Stock, best_fit, container_report, pack, plan, reduce_by_dominance
from kinfold.llm.tokens import count_tokens, VOCABULARY


def items(patterns):
    out = Counter()
    for p in patterns:
        for s in p.sizes:
            out[s] += p.count
    return out


def least(sizes, capacity):
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= sizes[k] and rooms[i] not in rooms[:i]:
                place(k + 1, [*rooms[:i], rooms[i] - sizes[k], *rooms[i + 1 :]])
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(30))
def test_reduction_keeps_a_best_packing(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 20) for _ in range(9)]
    stock = _Stock(Counter(sizes))
    fixed = reduce_by_dominance(stock, 20)
    rest = [s for s, n in stock.left.items() for _ in range(n)]
    assert items(fixed) + Counter(rest) == Counter(sizes)
    assert sum(p.count for p in fixed) + least(rest, 20) == least(sizes, 20)


@pytest.mark.parametrize("seed", range(40))
def test_reduction_of_threes_keeps_a_best_packing(seed):
    rng = random.Random(100 + seed)
    sizes = [rng.randint(20, 55) for _ in range(9)]
    stock = _Stock(Counter(sizes))
    fixed = reduce_by_dominance(stock, 100)
    rest = [s for s, n in stock.left.items() for _ in range(n)]
    assert items(fixed) + Counter(rest) == Counter(sizes)
    assert sum(p.count for p in fixed) + least(rest, 100) == least(sizes, 100)


def test_three_items_are_fixed():
    """Sizes of about a third of the room: sets of three are decided, in bulk."""
    stock = _Stock({34: 1000, 33: 2000})
    fixed = reduce_by_dominance(stock, 100)
    assert [(sorted(p.sizes), p.count) for p in fixed] == [([33, 33, 34], 1000)] and not stock.left


@pytest.mark.parametrize("seed", range(10))
def test_plan(seed):
    rng = random.Random(seed)
    h = Counter(min(100, int(rng.expovariate(1 / 25)) + 1) for _ in range(20_000))
    patterns = plan(dict(h), 100)
    assert items(patterns) == h and all(sum(p.sizes) <= 100 for p in patterns)
    total = sum(s * n for s, n in h.items())
    assert sum(p.count for p in patterns) <= total / 100 * 1.02 + 1
    assert len(patterns) < 5000
    assert best_fit(_Stock({}), 10) == []


def test_pack(spark):
    rng = random.Random(1)
    texts = [None, "", "word " * 90, *[" ".join(rng.choice(["ab", "cd", "ef"]) for _ in range(rng.randrange(1, 40))) for _ in range(300)], *["same text"] * 200]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").withColumn("place", F.lit("x")).withColumn("n_tokens", F.lit(-1))
    rows = pack(df, 32).collect()
    by, doc = defaultdict(list), defaultdict(list)
    for r in rows:
        doc[r.doc_id].append(r)
        if r.container_id is not None:
            by[r.container_id].append(r)
    assert set(doc) == set(range(len(texts)))
    for i, parts in doc.items():
        n = count_tokens(texts[i], VOCABULARY)
        assert sum(p.n_tokens for p in parts) == n and (len(parts) == max(1, -(-n // 32)))
        assert (n > 0) == all(p.container_id is not None for p in parts)
    for parts in by.values():
        assert sum(p.n_tokens for p in parts) <= 32 and sorted(p.place for p in parts) == list(range(len(parts)))
    report = container_report(pack(df, 32), 32).first()
    assert report.containers == len(by) and report.used_share > 0.97
    assert sorted(by) == list(range(len(by)))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert pack(df, 16).count() == 0
    assert container_report(pack(df, 16), 16).first().containers == 0
