import pytest
from pyspark.sql import functions as F
from test_missing import PLACEHOLDERS

from kinfold.plans.pipeline import Config, Pipeline
from kinfold.plans.tables import table


@pytest.fixture(scope="module")
def registry(spark, data, tmp_path_factory):
    labels = table(spark, data, "labelled_pairs").select(F.trim("left_id").alias("left_id"), F.trim("right_id").alias("right_id"), "is_match")
    p = Pipeline(spark, str(tmp_path_factory.mktemp("pipeline")), table(spark, data, "catalog_records"), labels, Config().override(neighbours=10, threshold=0.5))
    p.run(end="cluster")
    return p.registry


def test_candidates_are_scored_and_clustered(registry):
    ids = lambda name: {(r[0], r[1]) for r in registry.load(name).select("left_id", "right_id").collect()}
    found = {tuple(sorted((r.record1_id, r.record2_id))) for r in registry.load("candidates").collect()}
    assert found and found <= ids("scored") | ids("prefiltered")
    people = {}
    for r in registry.load("cells").where("field = 'person' AND hash IS NOT NULL").collect():
        people.setdefault(r.hash, set()).add(r.record_id)
    assert all((min(x), y) in found for x in people.values() for y in x - {min(x)})
    near = registry.load("neighbours").where("similarity >= 0.3 AND query <> item").collect()
    assert all(tuple(sorted((a, b))) in found for n in near for a in people[n["query"]] for b in people[n["item"]])
    assert registry.load("scored").where("part = 'train' AND label IS NULL").count() == 0
    labelled = {x for r in registry.load("scored").where("label IS NOT NULL").collect() for x in (r.left_id, r.right_id)}
    assert {r.entity_id for r in registry.load("clusters").collect()} - labelled


def test_texts_without_statement_are_imputed(registry):
    cells = registry.load("cells").where("field IN ('provision', 'subjects')").collect()
    empty = {r.hash for r in cells if r.value in PLACEHOLDERS}
    imputed = registry.load("imputed").collect()
    assert empty and not empty & {r.hash for r in imputed}
    assert {(r.record_id, r.field) for r in imputed} & {(r.record_id, r.field) for r in cells if r.hash in empty}
    counts = {f: sum(r.field == f and (r.hash is None or r.hash in empty) for r in cells) for f in ("provision", "subjects")}
    print("lacking", counts, "imputed", {f: sum(r.field == f for r in imputed) for f in counts})


def test_report_and_status(spark, data, registry):
    p = Pipeline(spark, registry.folder, table(spark, data, "catalog_records"), table(spark, data, "labelled_pairs"))
    assert p.check_inputs() == [] and Pipeline(spark, registry.folder, p.rows.drop("person"), p.labels.limit(0)).check_inputs() == ["rows lack the column person", "no labels"]
    p.run(start="analyze")
    status = {r.stage: r for r in p.status().collect()}
    assert [r.stage for r in sorted(status.values(), key=lambda r: r.place)] == list(p.stages) and {r.status for r in status.values()} == {"completed"}
    summary = p.summary()
    assert summary["datasets"]["clusters"] == p.load("cluster")["clusters"].count() and summary["metrics"]["tp"] > 0 and summary["clusters"]["clusters"] > 0
    assert {r.section for r in registry.load("report").collect()} >= {"confusion", "importance", "misclassified", "precision_recall", "imputed", "stages", "largest_clusters"}
    written = spark.read.option("header", True).csv(registry.folder + "/clusters.csv")
    assert written.columns == ["cluster_id", "entity_id"] and written.count() == summary["datasets"]["clusters"]
