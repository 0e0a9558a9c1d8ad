import random

from pyspark.sql import functions as F

from kinfold.llm.components import match_groups


def brute(pairs):
    near = {}
    for a, b in pairs:
        a, b = (a or "").strip(), (b or "").strip()
        if a and b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for s in near:
        if s in out:
            continue
        seen, todo = {s}, [s]
        while todo:
            for v in near[todo.pop()] - seen:
                seen.add(v)
                todo.append(v)
        out |= dict.fromkeys(seen, (min(seen), len(seen)))
    return out


def check(spark, pairs, **more):
    df = spark.createDataFrame(pairs, "record1_id string, record2_id string").withColumn("a", F.lit(1)).withColumn("root", F.lit("x")).withColumn("id", F.lit(None).cast("string"))
    assert {r.record_id: (r.group_id, r.group_size) for r in match_groups(df, **more).collect()} == brute(pairs)


def test_dirty_pairs(spark):
    check(spark, [("b", " a"), ("a\t", "b"), ("a", "b"), ("c", None), (None, None), ("", "d"), ("e", "  "), ("f", "f"), ("x", "y"), ("y", "z")])


def test_empty(spark):
    check(spark, [])
    check(spark, [(None, "a"), ("", "b")])


def test_shapes(spark):
    chain = [(f"c{i:04}", f"c{i + 1:04}") for i in range(400)]
    star = [("hub", f"s{i}") for i in range(300)]
    tail = [("s7", "t0"), *[(f"t{i}", f"t{i + 1}") for i in range(60)]]
    ring = [(f"r{i}", f"r{(i + 1) % 50}") for i in range(50)]
    pairs = chain + star + tail + ring
    random.Random(1).shuffle(pairs)
    check(spark, pairs)
    check(spark, pairs, rounds=1000)  # the whole giant component by its frontier
    check(spark, pairs, rounds=1)  # none of it but its start


def test_random_graphs(spark):
    rng = random.Random(5)
    check(spark, [(str(rng.randrange(400)), str(rng.randrange(400))) for _ in range(260)])
