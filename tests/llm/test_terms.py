import random
import re
from collections import Counter

from pyspark.sql import functions as F

from kinfold.llm import terms
from kinfold.llm.terms import BurstTrie, banded, term_counts


def test_trie():
    rng = random.Random(2)
    t, plain = BurstTrie(burst=4), Counter()
    for _ in range(3000):
        w = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 9)))
        t.add(w, 2, 1)
        plain[w] += 1
    got = {p + s: c for p, part in t.containers() for s, c in part.items()}
    assert got == {w: [2 * n, n] for w, n in plain.items()}
    assert all(len(part) <= 4 for _, part in t.containers()) and list(t.burst_prefixes())


def brute(rows):
    occ, rec = Counter(), Counter()
    for g, v, f, r in rows:
        if g is None or v is None:
            continue
        words = re.findall(r"[^\W_]+", v.lower())
        for w in words:
            occ[g, w] += f or 0
        for w in set(words):
            rec[g, w] += r or 0
    return {k: (occ[k], rec[k]) for k in occ}


def check(spark, rows):
    df = spark.createDataFrame(rows, "g string, v string, f bigint, r bigint").withColumn("term", F.lit("x")).withColumn("prefix", F.lit(0)).repartition(3)
    assert {(x.g, x.term): (x.occurrences, x.records) for x in term_counts(df, "g", "v", "f", "r").collect()} == brute(rows)


def test_counts(spark):
    check(spark, [("a", "The the; cat_dog 12b", 2, 3), ("a", "the Éa 中文", 1, 1), ("b", "the", None, None), ("a", None, 1, 1), (None, "x", 1, 1), ("a", "", 1, 1), ("a", "--", 5, 5), ("a", "w" * 50_000, 1, 1)])
    check(spark, [])


def test_routes(spark, monkeypatch):
    monkeypatch.setattr(terms, "BURST", 8)
    monkeypatch.setattr(terms, "ROUTES", 64)
    rng = random.Random(4)
    check(spark, [("a", " ".join("common" if rng.random() < 0.3 else "".join(rng.choice("abcd") for _ in range(6)) for _ in range(8)), 1, rng.randrange(3)) for _ in range(900)])


def test_bands(spark):
    counts = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("a", "z", 2), ("b", "x", 1)], "g string, term string, records bigint")
    totals = spark.createDataFrame([("a", 30), ("b", 5)], "g string, total bigint")
    assert {(r.g, r.term): r.band for r in banded(counts, totals, "g").collect()} == {("a", "x"): "rare", ("a", "y"): "common", ("a", "z"): "usable", ("b", "x"): "rare"}
