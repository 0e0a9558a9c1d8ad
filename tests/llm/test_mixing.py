import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm.mixing import default_schedules, demand, mix, position


def test_schedule_inverse():
    for schedule in ([(0, 1), (1, 1)], [(0, 0.2), (0.4, 0.9), (1, 0.1)], [(0, 0), (1, 2)]):
        whole = demand(schedule, np.array([1.0]))[0]
        t = np.linspace(0, 1, 101)
        assert position(schedule, demand(schedule, t) / whole) == pytest.approx(t, abs=1e-6)


def test_default_schedules():
    shares = {"a": 0.5, "b": 0.3, "c": 0.2}
    s = default_schedules(shares, {"a": 0.5, "b": 1.0, "c": 3.0})
    for k in (0, 1):
        assert sum(x[k][1] for x in s.values()) == pytest.approx(1) and all(x[k][1] > 0 for x in s.values())
    assert all((x[0][1] + x[1][1]) / 2 == pytest.approx(shares[n]) for n, x in s.items())


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["big"] * 6 + ["mid"] * 2 + ["small", "free"]), "word " * rng.randrange(1, 30)) for i in range(4000)]
    rows += [(9001, None, "x y"), (9002, "big", None), (9003, "big", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("position", F.lit("x")).withColumn("target_share", F.lit(1))
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.15, 3), ("absent", 0.05, 4), ("big", 0.5, 1), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    mixture, shares = mix(docs, targets)
    return mixture.collect(), {r.source: r for r in shares.collect()}


def test_shares(mixed):
    rows, shares = mixed
    assert set(shares) == {"big", "mid", "small", "absent"} and shares["absent"].actual_share == 0
    for s, share in (("big", 0.5), ("mid", 0.3), ("small", 0.15)):
        assert shares[s].actual_share == pytest.approx(share / 0.95, abs=0.002)
    uses = Counter((r.source, r.doc_id) for r in rows)
    most = {"big": 1, "mid": 2, "small": 3}
    assert all(n <= most[s] for (s, _), n in uses.items()) and {s for s, _ in uses} == set(most)
    full = [s for s in most if shares[s].used_tokens >= shares[s].available_tokens * most[s]]
    assert full  # the mixture cannot be longer


def test_order(mixed):
    rows, _ = mixed
    p = [r.position for r in rows]
    assert p == sorted(p) and 0 <= p[0] and p[-1] <= 1
    seen = defaultdict(list)
    for r in rows:
        seen[r.source].append(r.pass_no)
    assert all(x == sorted(x) for x in seen.values())  # a pass ends before the next begins
    tokens = lambda part: Counter({s: sum(r.n_tokens for r in part if r.source == s) for s in ("big", "small")})
    half = len(rows) // 2
    assert tokens(rows[:half])["small"] < tokens(rows[half:])["small"]  # what repeats comes in later


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    mixture, shares = mix(docs, targets)
    assert mixture.count() == 0 and shares.first().used_tokens == 0
    mixture, shares = mix(spark.createDataFrame([(1, "a", "x")], docs.schema), targets.limit(0))
    assert mixture.count() == 0 and shares.count() == 0
