"""The stages in order over a registry, with runs recorded and completed stages skipped."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.text import normalize_text
from kinfold.operators import classify, graph, ingest, knn, pairs, quality
from kinfold.operators.hotdeck import states_nothing
from kinfold.operators.skew import lookup_join
from kinfold.sources.embedder import embed_strings, hashing_embedder
from kinfold.sources.exports import export_csv, html_report
from kinfold.sources.registry import Registry


@dataclass(frozen=True)
class Config:
    """Settings and their defaults; `override` returns a changed copy.

    impute_from: "field" takes the nearest value of the missing field itself, "composite" what records of near composites have.
    """

    train_share: float = 0.7
    neighbours: int = 200
    similarity: float = 0.30
    impute_neighbours: int = 10
    impute_from: str = "field"
    least_person: float = 0.3
    regularization: float = 1.0
    max_iter: int = 1000
    tolerance: float = 1e-4
    threshold: float = 0.90
    algorithm: str = "connected_components"
    least_edge: float = 0.5
    largest_cluster: int = 1000
    connectivity: float = 0.5
    transitivity: bool = True
    dimensions: int = 64

    def override(self, **changes: Any) -> Config:
        unknown = set(changes) - set(self.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return replace(self, **changes)

    def override_text(self, changes: dict[str, str]) -> Config:
        """Values as text, read as the type of the setting's default."""
        kinds = {k: type(getattr(self, k)) for k in self.__dataclass_fields__}
        read = {bool: lambda x: x.lower() in ("1", "true", "yes")}
        return self.override(**{k: read.get(kinds.get(k, str), kinds.get(k, str))(v) for k, v in changes.items()})

    @classmethod
    def load(cls, path: str) -> Config:
        """From a JSON file, or a YAML file where a reader for that is installed."""
        text = Path(path).read_text()
        if path.endswith((".yml", ".yaml")):
            import yaml

            return cls().override(**yaml.safe_load(text))
        return cls().override(**json.loads(text))


@dataclass
class Pipeline:
    """preprocess, embed, query, impute, features, classify, cluster, analyze, report; each stage reads and writes datasets of the registry."""

    spark: SparkSession
    folder: str
    rows: DataFrame
    labels: DataFrame
    config: Config = field(default_factory=Config)
    order: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        self.registry = Registry(self.spark, self.folder)
        self.stages: dict[str, tuple[Callable[[], dict[str, DataFrame]], tuple[str, ...]]] = {
            "preprocess": (self._preprocess, ("strings", "records", "cells", "field_hash", "field_statistics")),
            "embed": (self._embed, ("vectors",)),
            "query": (self._query, ("neighbours", "candidates")),
            "impute": (self._impute, ("imputed",)),
            "features": (self._features, ("pair_features", "prefiltered")),
            "classify": (self._classify, ("model", "scored", "metrics")),
            "cluster": (self._cluster, ("edges", "clusters")),
            "analyze": (self._analyze, ("feature_statistics", "feature_ranges", "cluster_statistics", "cluster_sizes", "largest_clusters")),
            "report": (self._report, ("report",)),
        }

    def completed(self) -> list[str]:
        there = {r["name"] for r in self.registry.datasets().select("name").collect()}
        return [s for s, (_, out) in self.stages.items() if there.issuperset(out)]

    def load(self, stage: str) -> dict[str, DataFrame]:
        """The datasets that a completed stage has written."""
        return {name: self.registry.load(name) for name in self.stages[stage][1]}

    def status(self) -> DataFrame:
        """(stage, status, rows, seconds, per_second, place): how each stage last ran, in their order; stages that never ran are pending."""
        known = self.spark.createDataFrame([(s,) for s in self.stages], "stage string")
        if self.registry.exists("runs"):
            r = self.registry.load("runs").where("status <> 'skipped'")
            last = r.groupBy("stage").agg(F.max_by(F.struct("status", "rows", "started", "ended"), "started").alias("l")).select("stage", "l.*")
            out = known.join(F.broadcast(last), "stage", "left")
        else:
            out = known.select("stage", *[F.lit(None).cast(t).alias(c) for c, t in (("status", "string"), ("rows", "bigint"), ("started", "timestamp"), ("ended", "timestamp"))])
        seconds = (F.unix_micros("ended") - F.unix_micros("started")) / 1e6
        out = out.select("stage", F.coalesce("status", F.lit("pending")).alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce(seconds, F.lit(0.0)).alias("seconds"), F.coalesce(F.try_divide(F.col("rows"), seconds), F.lit(0.0)).alias("per_second"))
        return quality.in_stage_order(out, "stage", list(self.stages))

    def summary(self) -> dict[str, Any]:
        """What a dashboard shows: stages, rows of each dataset, metrics of the classifier, statistics of the clusters."""
        one = lambda name: self.registry.load(name).first().asDict() if self.registry.exists(name) else None
        return {
            "stages": [r.asDict() for r in self.status().collect()],
            "datasets": {r["name"]: r["rows"] for r in self.registry.datasets().select("name", "rows").collect()},
            "metrics": one("metrics"),
            "clusters": one("cluster_statistics"),
        }

    def check_inputs(self) -> list[str]:
        """What keeps the inputs from being used; empty if nothing."""
        lacking = [f"rows lack the column {c}" for c in ("personid", *ingest.FIELDS, "batch_no", "changed_at") if c not in self.rows.columns]
        lacking += [f"labels lack the column {c}" for c in ("left_id", "right_id", "is_match") if c not in self.labels.columns]
        return lacking + [f"no {n}" for n, df in (("rows", self.rows), ("labels", self.labels)) if df.limit(1).count() == 0]

    def run(self, start: str | None = None, end: str | None = None, again: bool = False, stop_on_error: bool = True) -> DataFrame:
        """(stage, status, started, ended, rows): stages from `start` to `end`; completed ones are skipped unless again=True."""
        names = list(self.stages)
        chosen = names[names.index(start) if start else 0 : (names.index(end) + 1) if end else None]
        done = set() if again else set(self.completed())
        log = []
        for name in chosen:
            began = datetime.now(UTC).replace(tzinfo=None)
            status, rows = "skipped", 0
            if name not in done:
                try:
                    for dataset, df in self.stages[name][0]().items():
                        self.registry.save(dataset, df, name)
                        rows += self.registry.metadata(dataset)["rows"]
                    status = "completed"
                except Exception as e:
                    if stop_on_error:
                        raise
                    status = f"failed: {type(e).__name__}"
            log.append((name, status, began, datetime.now(UTC).replace(tzinfo=None), rows))
        runs = self.spark.createDataFrame(log, "stage string, status string, started timestamp, ended timestamp, rows bigint")
        self.registry.append("runs", runs, "run")
        return runs

    def _preprocess(self) -> dict[str, DataFrame]:
        valid = ingest.valid_records(self.rows, "personid").withColumnRenamed("personid", "record_id")
        everything = ingest.cells(valid, "record_id", ["batch_no", "changed_at"])
        records = ingest.latest_records(valid, "record_id", ["changed_at", "batch_no"])
        texts = records.select("record_id", *[normalize_text(F.col(f)).alias(f) for f in ingest.FIELDS])
        cells = ingest.cells(records, "record_id")
        counts = ingest.field_hash_counts(cells)
        return {"strings": ingest.string_dictionary(everything, ["batch_no", "changed_at"]), "records": texts, "cells": cells, "field_hash": counts, "field_statistics": ingest.field_statistics(counts)}

    def _embed(self) -> dict[str, DataFrame]:
        strings = self.registry.load("strings").select("hash", "value")
        wanted = self.registry.load("field_hash").where(F.col("field").isin(*ingest.EMBEDDED)).select("hash", "field")
        vectors = embed_strings(strings.join(wanted.select("hash").distinct(), "hash", "left_semi"), "hash", "value", hashing_embedder(self.config.dimensions))
        return {"vectors": vectors.join(wanted, "hash").select("hash", "field", "v")}

    def _of(self, name: str) -> DataFrame:
        return self.registry.load("vectors").where(F.col("field") == name).select(F.col("hash").alias("id"), "v")

    def _query(self) -> dict[str, DataFrame]:
        x = self._of("person")
        top = knn.exact_top_k(x, x, "id", "v", self.config.neighbours)
        people = self.registry.load("cells").where("field = 'person' AND hash IS NOT NULL").select("record_id", F.col("hash").alias("person"))
        found = knn.candidates(top, self.config.similarity)
        across = knn.record_candidates(found, people, "record_id", "person", every=True)
        # records of one hash meet through the smallest of them
        first = people.groupBy("person").agg(F.min("record_id").alias("record2_id"))
        within = lookup_join(people, first, ["person"], "record_id").where("record_id <> record2_id").select(F.col("record_id").alias("record1_id"), F.col("person").alias("record1_hash"), F.col("person").alias("record2_hash"), F.lit(1.0).alias("similarity"), "record2_id")
        return {"neighbours": top, "candidates": across.unionByName(within)}

    def _impute(self) -> dict[str, DataFrame]:
        if self.config.impute_from not in ("field", "composite"):
            raise ValueError(f"unknown source of imputed values {self.config.impute_from!r}")
        cells = self.registry.load("cells")
        composite = cells.where("field = 'composite' AND hash IS NOT NULL").select("record_id", F.col("hash").alias("c"))
        missing = ingest.missing_fields(cells, "record_id").select("record_id", F.explode("missing").alias("field"))
        missing = missing.unionByName(cells.where(states_nothing(F.col("value"))).select("record_id", "field")).distinct()
        present = cells.join(missing, ["record_id", "field"], "left_anti")
        out = None
        for name in ("provision", "subjects"):
            have = composite.join(present.where(F.col("field") == name).select("record_id", F.col("hash").alias("value")), "record_id")
            values = have.groupBy(F.col("c").alias("item")).agg(F.min("value").alias("value"))
            lacking = composite.join(have.select("record_id"), "record_id", "left_anti")
            x = self._of("composite")
            if self.config.impute_from == "field":
                # the composite's vector against those of the field itself, of texts that state something
                stated = present.where((F.col("field") == name) & F.col("hash").isNotNull()).select(F.col("hash").alias("id")).distinct()
                asks = x.join(lacking.select(F.col("c").alias("id")).distinct(), "id", "left_semi")
                near = knn.exact_top_k(asks, self._of(name).join(stated, "id", "left_semi"), "id", "v", 2 * self.config.impute_neighbours)
                filled = near.where((F.col("rank") == 1) & (F.col("similarity") >= self.config.similarity)).select("query", F.col("item").alias("hash"), "similarity")
                part = lacking.join(filled, F.col("c") == F.col("query")).select("record_id", F.lit(name).alias("field"), "hash", "similarity")
                out = part if out is None else out.unionByName(part)
                continue
            top = knn.exact_top_k(x.join(lacking.select(F.col("c").alias("id")), "id", "left_semi"), x.join(values.select(F.col("item").alias("id")), "id", "left_semi"), "id", "v", self.config.impute_neighbours)
            filled = knn.impute_nearest(top, values, self.config.similarity)
            part = lacking.join(filled, F.col("c") == F.col("query")).select("record_id", F.lit(name).alias("field"), F.col("value").alias("hash"), "similarity")
            out = part if out is None else out.unionByName(part)
        return {"imputed": out}

    def _features(self) -> dict[str, DataFrame]:
        truth = pairs.ground_truth(self.labels, "left_id", "right_id", "is_match").withColumn("label", F.col("match").cast("int")).drop("match")
        found = self.registry.load("candidates").where("record1_id <> record2_id").select(F.least("record1_id", "record2_id").alias("left_id"), F.greatest("record1_id", "record2_id").alias("right_id")).distinct()
        both = pairs.with_records(found.join(truth, ["left_id", "right_id"], "full"), pairs.with_years(self.registry.load("records").select("record_id", "person", "title", "provision", "subjects", "composite")), "record_id")
        decided = both.withColumn("decision", pairs.prefilter(self.config.least_person, years=True))
        return {"pair_features": pairs.pair_features(decided.where("decision IS NULL").drop("decision")), "prefiltered": decided.where("decision IS NOT NULL").select("left_id", "right_id", "label", "decision")}

    def _classify(self) -> dict[str, DataFrame]:
        features = self.registry.load("pair_features")
        # the model is fitted on labelled pairs and scores all
        split = classify.stratified_split(features.where("label IS NOT NULL"), "pair_id", "label", self.config.train_share)
        features = split.unionByName(features.where("label IS NULL").withColumn("part", F.lit(None).cast("string")))
        scaled = classify.standardize(features, pairs.FEATURES, F.col("part") == "train")
        classify.validate(scaled.where("part = 'train'"), pairs.FEATURES, "label")
        c, b = classify.train_logistic(scaled.where("part = 'train'"), pairs.FEATURES, "label", self.config.regularization, self.config.max_iter, self.config.tolerance)
        scored = classify.score(scaled, dict(zip(pairs.FEATURES, c, strict=True)), b, self.config.threshold)
        kept = scored.select("pair_id", "left_id", "right_id", "label", "part", "probability", "prediction")
        model = self.spark.createDataFrame([*zip(pairs.FEATURES, c, strict=True), ("intercept", b)], "feature string, coefficient double")
        return {"model": model, "scored": kept, "metrics": classify.metrics(classify.confusion(scored.where("part = 'test'")))}

    def _cluster(self) -> dict[str, DataFrame]:
        scored = self.registry.load("scored").where("prediction = 1").select("left_id", "right_id", F.col("probability").alias("weight"))
        sure = self.registry.load("prefiltered").where("decision").select("left_id", "right_id", F.lit(1.0).alias("weight"))
        edges = graph.build_edges(scored.unionByName(sure), "left_id", "right_id", "weight", self.config.least_edge)
        if self.config.transitivity:
            edges = edges.unionByName(graph.transitive_edges(edges, self.config.least_edge))
        edges = self.registry.save("edges", edges, "cluster")
        run = {
            "connected_components": lambda: graph.split_oversize(graph.connected_components(edges, "src", "dst"), edges, self.config.largest_cluster, self.config.connectivity),
            "louvain": lambda: graph.louvain(edges),
            "label_propagation": lambda: graph.label_propagation(edges),
            "hierarchical": lambda: graph.hierarchical(edges, self.config.connectivity),
        }
        if self.config.algorithm not in run:
            raise ValueError(f"unknown algorithm {self.config.algorithm!r}")
        return {"clusters": run[self.config.algorithm]().toDF("entity_id", "cluster_id")}

    def _analyze(self) -> dict[str, DataFrame]:
        features, clusters = self.registry.load("pair_features"), self.registry.load("clusters")
        sizes = quality.cluster_sizes(clusters, "cluster_id")
        return {
            "feature_statistics": quality.describe(features, pairs.FEATURES),
            "feature_ranges": quality.ranges(features, pairs.FEATURES),
            "cluster_statistics": quality.cluster_statistics(sizes),
            "cluster_sizes": quality.size_buckets(sizes),
            "largest_clusters": quality.largest_clusters(sizes, "cluster_id"),
        }

    def _report(self) -> dict[str, DataFrame]:
        tables = {n: self.registry.load(n) for n in ("field_statistics", "metrics", "model", "feature_statistics", "feature_ranges", "cluster_statistics", "cluster_sizes", "largest_clusters")}
        scored = self.registry.load("scored").where("label IS NOT NULL")
        tables["importance"] = classify.coefficient_importance(tables["model"])
        tables["confusion"] = classify.confusion(scored)
        tables["misclassified"] = classify.misclassified(scored).groupBy("kind").agg(F.count(F.lit(1)).alias("pairs"), F.avg("probability").alias("mean_probability"))
        tables["precision_recall"] = classify.precision_recall_area(scored)
        tables["imputed"] = self.registry.load("imputed").groupBy("field").agg(F.count(F.lit(1)).alias("cells"), F.avg("similarity").alias("mean_similarity"))
        tables["stages"] = self.status()
        if "://" not in self.folder or self.folder.startswith("file:"):
            folder = self.folder.removeprefix("file://")
            html_report("Entity resolution", tables, folder + "/report.html")
            Path(folder + "/summary.json").write_text(json.dumps(self.summary(), default=str, indent=1))
        export_csv(self.registry.load("clusters").select("cluster_id", "entity_id"), self.folder + "/clusters.csv")
        return {"report": self.spark.createDataFrame([(n, t.count()) for n, t in tables.items()], "section string, rows bigint")}
