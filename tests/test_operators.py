import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinfold.operators import classify, graph, hotdeck, ingest, knn, pairs, quality, skew

EDGES = [("a", "b", 0.9), ("b", "c", 0.8), ("c", "d", 0.6), ("x", "y", 0.95)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "src string, dst string, weight double")


def mapping(df):
    return {r[0]: r[1] for r in df.collect()}


def test_components(spark, edges):
    assert mapping(graph.connected_components(edges, "src", "dst")) == {**dict.fromkeys("abcd", "a"), **dict.fromkeys("xy", "x")}
    rows = [("p", None), (None, None), ("q", "q"), ("s", "r"), ("r", "s")]
    assert mapping(graph.connected_components(spark.createDataFrame(rows, "m string, n string"), "m", "n")) == {"q": "q", "r": "r", "s": "r"}
    assert mapping(graph.connected_components(spark.createDataFrame([], "m string, n string"), "m", "n")) == {}


def test_transitive(edges):
    assert [(r.src, r.dst, round(r.weight, 6)) for r in graph.transitive_edges(edges, 0.5).collect()] == [("a", "c", 0.72)]


def test_oversize(spark, edges):
    closed = edges.unionByName(graph.transitive_edges(edges, 0.5))
    got = graph.split_oversize(graph.connected_components(closed, "src", "dst"), closed, 3, 0.7)
    assert mapping(got) == {"a": "a", "b": "a", "c": "a", "d": "d", "x": "x", "y": "x"}


def test_graph_statistics(spark, edges):
    s = graph.graph_statistics(edges).first()
    assert (s.nodes, s.edges, s.components) == (6, 4, 2)
    assert s.density == pytest.approx(8 / 30) and s.average_degree == pytest.approx(8 / 6) and s.average_clustering == 0
    triangle = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0), ("a", "c", 1.0), ("c", "d", 1.0)], edges.schema)
    assert mapping(graph.triangles(triangle)) == {"a": 1, "b": 1, "c": 1}


def two_cliques(spark):
    rows = [(f"{s}{i}", f"{s}{j}", 0.9) for s in "pq" for i in range(5) for j in range(i + 1, 5)] + [("p0", "q0", 0.6)]
    return spark.createDataFrame(rows, "src string, dst string, weight double")


@pytest.mark.parametrize("run", [graph.louvain, lambda e: graph.hierarchical(e, 0.5), graph.label_propagation])
def test_communities(spark, run):
    got = mapping(run(two_cliques(spark)))
    assert len(got) == 10
    assert {frozenset(k for k in got if got[k] == c) for c in set(got.values())} == {frozenset(f"{s}{i}" for i in range(5)) for s in "pq"}


def test_louvain_on_a_ring_of_cliques(spark):
    """Every clique of a ring of cliques stays whole, and a component of its own is treated alike."""
    rows = [(f"{c:02}-{i}", f"{c:02}-{j}", 1.0) for c in range(12) for i in range(6) for j in range(i + 1, 6)] + [(f"{c:02}-0", f"{(c + 1) % 12:02}-1", 1.0) for c in range(12)] + [("x", "y", 0.5)]
    got = mapping(graph.louvain(spark.createDataFrame(rows, "src string, dst string, weight double")))
    assert len(got) == 74 and got["x"] == got["y"] == "x"
    assert all(len({got[f"{c:02}-{i}"] for i in range(6)}) == 1 for c in range(12)) and len(set(got.values())) >= 7
    assert all(c == min(k for k in got if got[k] == c) for c in set(got.values()))


def test_label_propagation_unsettled(spark):
    with pytest.raises(RuntimeError):
        graph.label_propagation(two_cliques(spark), rounds=0)


def test_conflicts(spark, edges):
    m = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "2"), ("c", "2"), ("z", "9")], "id string, cluster string")
    assert mapping(graph.resolve_conflicts(m, edges)) == {"a": "1", "b": "1", "c": "2", "z": "9"}


def test_clusters(spark):
    sizes = spark.createDataFrame([("a", 4), ("x", 2)], "component string, size bigint")
    s = quality.cluster_statistics(sizes).first()
    assert (s["mean"], s["median"], s["std"]) == (3, 3, 1)
    assert [tuple(r) for r in quality.size_buckets(sizes).collect()] == [("2-5", 2, 6)]


def test_metrics(spark):
    df = spark.createDataFrame([("p", 1, 0.95), ("q", 1, 0.60), ("r", 0, 0.92), ("s", 0, 0.10)], "pair_id string, label int, probability double")
    for threshold, counts, shares in ((0.90, (1, 1, 1, 1), (0.5, 0.5, 0.5, 0.5)), (0.55, (2, 1, 1, 0), (2 / 3, 1.0, 0.8, 0.75))):
        scored = df.withColumn("prediction", (F.col("probability") >= threshold).cast("int"))
        m = classify.metrics(classify.confusion(scored)).first()
        assert (m.tp, m.fp, m.tn, m.fn) == counts
        assert (m.precision, m.recall, m.f1, m.accuracy) == pytest.approx(shares)
    assert classify.roc_auc(df).first().auc == 0.75
    curve = {r.threshold: (r.tpr, r.fpr) for r in classify.roc_curve(df).collect()}
    assert curve == {0.95: (0.5, 0), 0.92: (0.5, 0.5), 0.6: (1, 0.5), 0.1: (1, 1)}
    assert classify.threshold_marker(classify.roc_curve(df), 0.61).first().threshold == 0.6


def test_training(spark):
    rng = random.Random(3)
    rows = [(i, int(x + rng.gauss(0, 0.3) > 0.5), x, rng.random()) for i in range(400) for x in (rng.random(),)]
    df = spark.createDataFrame(rows, "id int, label int, good double, noise double")
    c, _ = classify.train_logistic(df, ["good", "noise"], "label")
    assert c[0] > 5 * abs(c[1])
    assert dict(classify.select_features(df, ["good", "noise"], "label", least=1)) == {"good": 1, "noise": 2}
    with pytest.raises(ValueError):
        classify.train_logistic(df.where("label = 1"), ["good"], "label")
    parts = Counter((r.label, r.part) for r in classify.stratified_split(df, "id", "label").collect())
    sizes = Counter(r[1] for r in rows)
    assert all(parts[k, "train"] == int(0.7 * n) for k, n in sizes.items()) and sum(parts.values()) == 400


def test_standardize(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "id int, a double, b double")
    assert [tuple(r) for r in classify.standardize(df, ["a", "b"]).orderBy("id").collect()] == [(1, -1.0, 0.0), (2, 1.0, 0.0)]


def test_neighbours(spark):
    x = spark.createDataFrame([("q", [1.0, 0.0]), ("n1", [0.8, 0.6]), ("n2", [0.4, 0.9165151389911681]), ("n3", [0.2, 0.9797958971132712]), ("none", None), ("zero", [0.0, 0.0])], "id string, v array<double>")
    for limit, expected in ((3, {"n1", "n2"}), (2, {"n1"})):
        top = knn.exact_top_k(x.where("id = 'q'"), x, "id", "v", limit, block=2)
        assert {r.hash2 for r in knn.candidates(top, 0.3).collect()} == expected


def test_prefilter(spark):
    rows = [("A, 1900-1950", "A, 1900-1950", "c1", "c2"), ("A", "A", "c", "c"), ("AAAA", "zzzzz", "c", "c"), ("AAAA", "zzzzz", "c", "d"), ("AAAA", "AAAB", "c", "d"), (None, "A", "c", "d"), (None, "A", None, None)]
    df = spark.createDataFrame(rows, "left_person string, right_person string, left_composite string, right_composite string")
    assert [r[0] for r in df.select(pairs.prefilter()).collect()] == [True, True, True, False, None, None, None]


def test_features(spark):
    cols = "left_id string, right_id string, " + ", ".join(f"{s}_{f} string" for s in ("left", "right") for f in ("person", "title", "provision", "subjects", "composite"))
    df = spark.createDataFrame([("1", "2", "A, 1900-1950", "t", None, "s", "x y", "A, 1900-1950", "t", "p", "s", "y x")], cols)
    r = pairs.pair_features(df).first().asDict()
    assert r["person_cosine"] == r["title_cosine"] == r["person_title_harmonic"] == r["has_birth_death_years"] == r["birth_year_match"] == 1
    assert r["provision_cosine"] == r["title_provision_harmonic"] == 0 and r["composite_cosine"] == 1


def test_records(spark):
    rows = [("1 ", "A", 1, 5), ("1", "B", 2, 3), (None, "C", 1, 1), ("unknown", "D", 1, 1), ("", "E", 1, 1), ("2", " a ", 1, 1)]
    df = ingest.valid_records(spark.createDataFrame(rows, "id string, person string, batch_no int, changed_at int"), "id")
    last = ingest.latest_records(df, "id", ["changed_at", "batch_no"])
    assert {r.id: r.person for r in last.collect()} == {"1": "A", "2": " a "}
    full = df.select("id", "batch_no", *[(F.col("person") if f == "person" else F.lit(None).cast("string")).alias(f) for f in ingest.FIELDS])
    words = ingest.string_dictionary(ingest.cells(full, "id", ["batch_no"]), ["batch_no"]).collect()
    assert {r.value: r.n for r in words} == {"A": 2, "B": 1}


def test_hot_deck_majority(spark):
    rows = [("1#a", "1", "x"), ("1#b", "1", "y"), ("1#c", "1", "y"), ("1#d", "1", None), ("2#a", "2", "q"), ("2#b", "2", "p"), ("2#c", "2", None), ("3#a", "3", None), ("4#a", None, None), ("4#b", None, "z")]
    df = spark.createDataFrame(rows, "id string, bib string, hash string").withColumn("value", F.lit("clash")).withColumn("filled", F.lit(1))
    got = {r.id: (r.value, r.filled, r.donors, r.donor_level) for r in hotdeck.hot_deck(df, "id", "hash", [["bib"]]).collect()}
    assert got["1#d"] == ("y", True, 3, 0) and got["2#c"] == ("p", True, 2, 0)
    assert got["3#a"] == got["4#a"] == (None, False, 0, None) and got["1#a"] == ("x", False, 0, None) and len(got) == 10


def test_hot_deck_levels_and_numbers(spark):
    rows = [("a", "g", 1.2, 10.0), ("b", "g", 1.4, 20.0), ("c", "g", 1.3, 90.0), ("d", "g", 7.0, 500.0), ("e", "g", 1.1, None), ("f", "g", None, None)]
    df = spark.createDataFrame(rows, "id string, grp string, size double, price double")
    levels = [["grp", hotdeck.bin_of(F.col("size"), 1.0)], ["grp"]]
    got = {r.id: (r.value, r.donor_level, r.donors) for r in hotdeck.hot_deck(df, "id", "price", levels, numeric=True).collect()}
    assert got["e"] == (20.0, 0, 3) and got["f"] == (20.0, 1, 4) and got["a"][0] == 10.0


def test_nearest_hot_deck(spark):
    rows = [("a", "g", "t", "x", 1.0, "p"), ("b", "g", "t", "y", 1.5, "q"), ("c", "g", "u", "x", 90.0, "q"), ("d", "g", "t", "x", 1.2, None), ("e", "g", None, "x", None, None), ("f", "g", "z", "z", 3.0, None), ("h", "h", "t", "x", 1.0, None), ("i", None, "t", "x", 1.0, None)]
    df = spark.createDataFrame(rows, "id string, grp string, title string, other string, size double, hash string").withColumn("value", F.lit("clash")).withColumn("donor", F.lit(0))
    run = lambda **more: {r.id: (r.value, r.donors, r.distance, r.donor) for r in hotdeck.nearest_hot_deck(df, "id", "hash", ["grp"], {"title": 2.0, "other": 1.0}, **more).collect()}
    near, whole, numbers = run(), run(whole_block=True), run(numbers={"size": (4.0, 1.0)})
    assert near["d"] == ("p", 1, 0.0, "a") and near["e"] == ("p", 2, 2.0, "a") and near["f"] == ("q", 3, 3.0, "b")
    assert whole["d"] == ("q", 3, 1.0, "b") and whole["f"] == ("q", 3, 3.0, "b")
    assert numbers["d"] == ("p", 1, 0.0, "a") and numbers["f"] == ("p", 2, 5.0, "a")
    assert all(x["h"] == x["i"] == (None, 0, None, None) and x["a"] == ("p", 0, None, None) for x in (near, whole, numbers))
    assert hotdeck.nearest_hot_deck(df.limit(0), "id", "hash", ["grp"], {"title": 1.0}).count() == 0


def test_weighted_median_of_a_hot_block(spark):
    """One block holds most records; its weighted lower median against a plain one."""
    rng = random.Random(4)
    rows = [(str(i), "hot" if i % 4 else f"b{i % 40}", None if i % 11 == 0 else rng.choice([rng.random() * 100, 5.0, 7.0]), rng.choice([0.5, 1.0, 3.0])) for i in range(4000)]
    df = spark.createDataFrame(rows, "id string, grp string, price double, w double")
    want = {}
    for g in {r[1] for r in rows}:
        values = sorted((r[2], r[3]) for r in rows if r[1] == g and r[2] is not None)
        whole, upto = sum(w for _, w in values), 0.0
        for v, w in values:
            upto += w
            if 2 * upto >= whole:
                want[g] = v
                break
    got = {r.id: r.value for r in hotdeck.hot_deck(df, "id", "price", [["grp"]], "w", numeric=True).where("filled").collect()}
    assert got == {r[0]: want[r[1]] for r in rows if r[2] is None}


def test_hot_deck_hot_block_and_empty(spark):
    rows = [(str(i), "hot" if i % 3 else f"b{i}", None if i % 7 == 0 else f"v{i % 4}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, bib string, hash string")
    votes = defaultdict(Counter)
    for _, b, v in rows:
        if v:
            votes[b][v] += 1
    best = {b: min(c, key=lambda v: (-c[v], v)) for b, c in votes.items()}
    got = {r.id: r.value for r in hotdeck.hot_deck(df, "id", "hash", [["bib"]]).where("filled").collect()}
    assert got == {i: best[b] for i, b, v in rows if v is None and b in best}
    assert hotdeck.hot_deck(df.limit(0), "id", "hash", [["bib"]]).count() == 0


def test_vacuous(spark):
    texts = [None, "", "-", "N/A", "nan", "NULL", "[s.n.]", "unknown", "?", "--", "none", "n.a.", "(null)", "Botany", "Nanking : None & Co."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(hotdeck.states_nothing(F.col("t"))).collect()] == [True] * 13 + [False] * 2


def test_ranked_and_lookup(spark):
    rows = [(i, None if i % 50 == 0 else "hot" if i % 3 else f"k{i % 40}", i % 11) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, k string, n int")
    got = skew.ranked(df, ["k"], ["id"], "rank", running=("n", "before"), rows_per_bucket=100).collect()
    by = defaultdict(list)
    for r in got:
        by[r.k].append(r)
    for part in by.values():
        part.sort(key=lambda r: r.rank)
        assert [r.rank for r in part] == list(range(len(part)))
        total = 0
        for r in part:
            assert r.before == total
            total += r.n
    small = spark.createDataFrame([("hot", 1), ("k3", 2), ("other", 3)], "k string, v int")
    joined = {r.id: r.v for r in skew.lookup_join(df, small, ["k"], "id").collect()}
    assert joined == {i: {"hot": 1, "k3": 2}.get(k) for i, k, _ in rows}
    assert skew.lookup_join(df, small, ["k"], "id", how="inner").count() == sum(k in ("hot", "k3") for _, k, _ in rows)


def test_validate(spark):
    good = [(0.1, 1), (0.2, 0), (0.3, 1)]
    frame = lambda rows: spark.createDataFrame(rows, "x double, y int")
    assert classify.validate(frame(good), ["x"], "y") is None
    for bad in ([], good[:1], [*good, (float("nan"), 1)], [*good, (None, 1)], [*good, (float("inf"), 0)], [*good, (0.1, 2)], [*good, (0.1, None)]):
        with pytest.raises(ValueError):
            classify.validate(frame(bad), ["x"], "y")
    with pytest.raises(ValueError):
        classify.validate(frame(good), ["x", "z"], "y")


def test_curves_with_crowded_scores(spark):
    """Nearly all scores are 0 or 1: curves and areas against brute force."""
    rows = [(i, [0.0, 1.0, 1.0, 0.999, 0.5 + i / 1e4][i % 5], int(i % 5 in (1, 2) or i % 7 == 0)) for i in range(1500)]
    df = spark.createDataFrame(rows, "i int, probability double, label int")
    points, tp, fp = [], 0, 0
    for s in sorted({r[1] for r in rows}, reverse=True):
        tp += sum(r[2] for r in rows if r[1] == s)
        fp += sum(1 - r[2] for r in rows if r[1] == s)
        points.append((s, tp, fp))
    n = sum(r[2] for r in rows)
    got = {r.threshold: (r.precision, r.recall) for r in classify.precision_recall_curve(df).collect()}
    assert got == {s: (pytest.approx(t / (t + f)), pytest.approx(t / n)) for s, t, f in points}
    area, last = 0.0, (1.0, 0.0)
    for _, t, f in points:
        p, r = t / (t + f), t / n
        area, last = area + (r - last[1]) * (p + last[0]) / 2, (p, r)
    one = classify.precision_recall_area(df).first()
    assert one["points"] == len(points) and one["area"] == pytest.approx(area)
    assert classify.precision_recall_area(df.limit(0)).first()["area"] == 0


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
    return row[-1]


def test_pair_features_with_token_sort(spark):
    """The whole feature set against a plain version: texts by sorted words and their longest common subsequence."""
    texts = [("Heath, Anna, 1801-1850", "A title of some length", "London, 1850", "Botany; Plants", "c one"), ("Anna Heath (1801-1850)", "some length of a title", "1850 London", "Plants; Botany", "c two"), ("Moor, Karl", "Other", None, "", "c"), (None, "Ünïcode títle", "Paris", "Maps", None)]
    records = spark.createDataFrame([(str(i), *t) for i, t in enumerate(texts)], "id string, person string, title string, provision string, subjects string, composite string")
    found = spark.createDataFrame([(str(a), str(b)) for a in range(4) for b in range(a + 1, 4)], "left_id string, right_id string")
    plain = pairs.pair_features(pairs.with_records(found, records, "id")).collect()
    years = {(r.left_id, r.right_id): r for r in pairs.pair_features(pairs.with_records(found, pairs.with_years(records), "id")).collect()}

    def sort_ratio(a, b):
        if a is None or b is None:
            return 0.0
        if a == b:
            return 1.0
        x, y = (" ".join(sorted(t.split())) for t in (a, b))
        return 2 * _lcs(x, y) / (len(x) + len(y)) if x or y else 0.0

    for r in plain:
        a, b = texts[int(r.left_id)], texts[int(r.right_id)]
        for k, f in ((1, "title"), (2, "provision"), (4, "composite")):
            if a[k] and b[k]:
                assert r[f"{f}_cosine"] == pytest.approx(sort_ratio(a[k], b[k]), abs=1e-6), (r.left_id, r.right_id, f)
        assert r.person_jaro_winkler == pytest.approx(sort_ratio(a[0], b[0]), abs=1e-6)
        assert all(r[f] == pytest.approx(years[r.left_id, r.right_id][f]) for f in pairs.FEATURES)
