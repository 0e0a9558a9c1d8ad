import json

import pytest
from pyspark.sql import functions as F

from kinfold.plans.pipeline import Config, Pipeline
from kinfold.plans.tables import table
from kinfold.sources.embedder import embed_strings, embed_text, hashing_embedder, vector_of
from kinfold.sources.exports import export_csv, export_json_sample
from kinfold.sources.readers import malformed_rows, read_catalog, read_labels
from kinfold.sources.registry import Registry


def test_catalog(spark, tmp_path):
    (tmp_path / "a.csv").write_text('personId,composite,person,roles,title,extra\n1,"c, d",P,,T,z\n')
    (tmp_path / "b.csv").write_text("personId,composite,person,roles,title,extra\n2,c,Q,r,,z\n")
    rows = read_catalog(spark, str(tmp_path))
    assert {r.personId: (r.composite, r.roles, r.subjects) for r in rows.collect()} == {"1": ("c, d", None, None), "2": ("c", "r", None)}
    first = rows.where("personId = '1'").select("file")
    assert [r.personId for r in read_catalog(spark, str(tmp_path), first).collect()] == ["2"]
    (tmp_path / "c.csv").write_text("personId,composite,person,roles,title,extra\n3,c,Q\n")
    assert malformed_rows(spark, str(tmp_path)).count() == 1
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "x.csv").write_text("personId,title\n1,t\n")
    with pytest.raises(ValueError):
        read_catalog(spark, str(tmp_path / "only"))


def test_labels(spark, tmp_path):
    (tmp_path / "h.csv").write_text("left,right,match\na,b,TRUE\n")
    (tmp_path / "n.csv").write_text("a,b,0\n")
    (tmp_path / "l.json").write_text(json.dumps([{"left": "a", "right": "b", "match": True}]))
    (tmp_path / "d.json").write_text(json.dumps({"a|b": True, "c|d": False, "bad": True}))
    read = lambda f, k: [tuple(r) for r in read_labels(spark, str(tmp_path / f), k).collect()]
    assert read("h.csv", "csv") == [("a", "b", "TRUE")] and read("n.csv", "bare") == [("a", "b", "0")]
    assert read("l.json", "list") == [("a", "b", "true")] and sorted(read("d.json", "dict")) == [("a", "b", "true"), ("c", "d", "false")]


def test_registry(spark, tmp_path):
    r = Registry(spark, str(tmp_path))
    assert not r.exists("x")
    r.save("x", spark.range(3), "s")
    one = r.metadata("x")
    r.save("x", spark.range(3).orderBy(F.desc("id")), "s")
    two = r.metadata("x")
    assert one["content"] == two["content"] and one["path"] != two["path"] and r.load("x").count() == 3
    r.delete("x")
    assert not r.exists("x")
    with pytest.raises(KeyError):
        r.load("x")


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("c", "e")], "cluster_id string, entity_id string")
    export_csv(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).collect() == df.collect()
    assert export_json_sample(df, str(tmp_path / "s.json"))["sample"] == [{"cluster_id": "c", "entity_id": "e"}]


def test_embedder(spark):
    df = spark.createDataFrame([("1", "abc"), ("2", "abc"), ("3", None), ("4", "xyz")], "id string, value string")
    got = {r.id: tuple(r.v) for r in embed_strings(df, "id", "value").collect()}
    assert set(got) == {"1", "2", "4"} and got["1"] == got["2"] != got["4"]
    calls = []

    def flaky(texts):
        calls.append(1)
        if len(calls) % 2:
            raise OSError
        return hashing_embedder(8)(texts)

    assert embed_strings(df, "id", "value", flaky).count() == 3


def test_pipeline(spark, data, tmp_path):
    labels = table(spark, data, "labelled_pairs").select(F.trim("left_id").alias("left_id"), F.trim("right_id").alias("right_id"), "is_match")
    p = Pipeline(spark, str(tmp_path), table(spark, data, "catalog_records"), labels, Config().override(neighbours=10, threshold=0.5))
    log = {r.stage: r.status for r in p.run().collect()}
    assert set(log.values()) == {"completed"} and (tmp_path / "report.html").exists()
    assert {r.status for r in p.run().collect()} == {"skipped"}
    clusters = p.registry.load("clusters")
    assert clusters.count() == clusters.select("entity_id").distinct().count() > 0


def test_config(tmp_path):
    with pytest.raises(ValueError):
        Config().override(nothing=1)
    (tmp_path / "c.json").write_text('{"neighbours": 7}')
    c = Config.load(str(tmp_path / "c.json")).override_text({"threshold": "0.5", "transitivity": "no"})
    assert (c.neighbours, c.threshold, c.transitivity) == (7, 0.5, False)


def test_columns_by_name_in_each_file(spark, tmp_path):
    a = "personId,composite,person,roles,title,provision,subjects\n1#a,c1,p1,r1,t1,v1,s1\n"
    b = 'person,composite,extra,personId,title,roles,subjects\np2,"c2, with\na break",x,2#a,t2,r2,s2\np3,c3,x,3#a,t3\n'
    (tmp_path / "a.csv").write_text(a)
    (tmp_path / "b.csv").write_text(b)
    got = {r.personId: (r.composite, r.person, r.roles, r.title, r.provision, r.subjects) for r in read_catalog(spark, str(tmp_path)).collect()}
    assert got == {"1#a": ("c1", "p1", "r1", "t1", "v1", "s1"), "2#a": ("c2, with\na break", "p2", "r2", "t2", None, "s2")}
    bad = malformed_rows(spark, str(tmp_path)).collect()
    assert [(r.file.rsplit("/", 1)[1], r.row.strip()) for r in bad] == [("b.csv", "p3,c3,x,3#a,t3")]
    done = spark.createDataFrame([(next(iter(r.file for r in bad)),)], "file string")
    assert [r.personId for r in read_catalog(spark, str(tmp_path), done).collect()] == ["1#a"]
    (tmp_path / "c.csv").write_text("personId,person\n4#a,p4\n")
    with pytest.raises(ValueError):
        read_catalog(spark, str(tmp_path)).collect()


def test_strict_labels(spark, tmp_path):
    (tmp_path / "l.csv").write_text("left,right,match\na,b,True\na,c,1\na,d,yes\na,e,\n")
    assert [r.is_match for r in read_labels(spark, str(tmp_path / "l.csv"), "strict").orderBy("right_id").collect()] == ["true", "false", "false", "false"]


def test_content_hash_counts_rows(spark, tmp_path):
    r = Registry(spark, str(tmp_path))
    r.save("one", spark.createDataFrame([("a",), ("b",), ("b",)], "x string"))
    r.save("two", spark.createDataFrame([("a",), ("c",), ("c",)], "x string"))
    assert r.metadata("one")["content"] != r.metadata("two")["content"]


def test_append_bundle_and_reset(spark, tmp_path):
    r = Registry(spark, str(tmp_path))
    df = lambda *x: spark.createDataFrame([(i,) for i in x], "x int")
    r.append("a", df(1))
    before = r.load("a")
    r.append("a", df(2, 3))
    assert sorted(x.x for x in r.load("a").collect()) == [1, 2, 3] and before.count() == 1 and r.metadata("a")["rows"] == 3
    r.save("a", df(9))
    assert [x.x for x in r.load("a").collect()] == [9]
    r.save_bundle("model", {"weights": df(1), "scores": df(1, 2)}, "r1")
    r.save_bundle("model", {"weights": df(5)}, "r2")
    assert {k: v.count() for k, v in r.load_bundle("model", "r1").items()} == {"weights": 1, "scores": 2}
    assert [x.x for x in r.load_bundle("model")["weights"].collect()] == [5]
    with pytest.raises(KeyError):
        r.load_bundle("model", "r9")
    r.reset()
    assert not r.exists("a") and r.datasets().count() == 0


def test_single_text_and_stored_vector(spark):
    df = spark.createDataFrame([("k", "Some text"), ("l", None)], "k string, t string")
    vectors = embed_strings(df, "k", "t")
    assert vector_of(vectors, "k", "k") == pytest.approx(embed_text("Some text")) and vector_of(vectors, "k", "l") is None
