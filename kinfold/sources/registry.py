"""A warehouse folder of named Parquet datasets with a catalogue table of what they are."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRIES = "name string, path string, stage string, rows bigint, content string, written timestamp, deleted boolean"


class Registry:
    """Each save writes a new version and appends its entry; readers see the last entry of a name. Entries are a Parquet table themselves."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _entries(self) -> DataFrame:
        path = f"{self.folder}/_catalogue"
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        there = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
        return self.spark.read.schema(_ENTRIES).parquet(path) if there else self.spark.createDataFrame([], _ENTRIES)

    def _append(self, **entry: object) -> None:
        self.spark.createDataFrame([tuple(entry[k] for k in ("name", "path", "stage", "rows", "content", "written", "deleted"))], _ENTRIES).coalesce(1).write.mode("append").parquet(f"{self.folder}/_catalogue")

    def datasets(self) -> DataFrame:
        """(name, path, stage, rows, content, written) of what is there now."""
        last = self._entries().groupBy("name").agg(F.max_by(F.struct("path", "stage", "rows", "content", "written", "deleted"), "written").alias("e")).select("name", "e.*")
        return last.where("NOT deleted").drop("deleted")

    def _read(self, path: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*path.split("\n"))

    def save(self, name: str, df: DataFrame, stage: str = "") -> DataFrame:
        """Writes the dataset as a new version; `content` is an order-free hash of all its rows, by their exclusive or and their sum, so that rows in pairs count too."""
        return self._write(name, df, stage, "")

    def append(self, name: str, df: DataFrame, stage: str = "") -> DataFrame:
        """Adds the rows to what the dataset holds, which is not written again; a new dataset where there is none. Readers of the version before see no change."""
        entry = self.metadata(name)
        return self._write(name, df, stage, entry["path"] + "\n" if entry else "")

    def _write(self, name: str, df: DataFrame, stage: str, before: str) -> DataFrame:
        now = datetime.now(UTC)
        path = f"{self.folder}/{name}/v{now.strftime('%Y%m%d%H%M%S%f')}"
        df.write.parquet(path)
        path = before + path
        saved = self._read(path, df.schema)
        plain = [F.to_json(c) if saved.schema[c].dataType.typeName() == "map" else F.col(c) for c in saved.columns]
        s = saved.agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("-", F.hex(F.coalesce(F.bit_xor(F.xxhash64(*plain)), F.lit(0))), F.coalesce(F.sum(F.xxhash64(*plain).cast("decimal(38,0)")), F.lit(0)).cast("string")).alias("content")).first()
        self._append(name=name, path=path, stage=stage, rows=s["rows"], content=s["content"], written=now.replace(tzinfo=None), deleted=False)
        return saved

    def metadata(self, name: str) -> dict | None:
        row = self.datasets().where(F.col("name") == name).first()
        return row.asDict() if row else None

    def exists(self, name: str) -> bool:
        return self.metadata(name) is not None

    def load(self, name: str) -> DataFrame:
        entry = self.metadata(name)
        if entry is None:
            raise KeyError(name)
        return self._read(entry["path"])

    def save_bundle(self, name: str, tables: dict[str, DataFrame], run: str) -> None:
        """Several tables under one run id, with an index (run, part, rows) of them, written last: a bundle without it is not complete."""
        for part, df in tables.items():
            self.save(f"{name}.{run}.{part}", df, run)
        rows = [(run, part, int(self.metadata(f"{name}.{run}.{part}")["rows"])) for part in tables]
        self.append(f"{name}.index", self.spark.createDataFrame(rows, "run string, part string, rows bigint"), run)

    def load_bundle(self, name: str, run: str | None = None) -> dict[str, DataFrame]:
        """The tables of a run, the last one by id if none is given."""
        index = self.load(f"{name}.index")
        run = run or index.agg(F.max("run")).first()[0]
        parts = [r["part"] for r in index.where(F.col("run") == run).select("part").distinct().collect()]
        if not parts:
            raise KeyError(f"{name} {run}")
        return {p: self.load(f"{name}.{run}.{p}") for p in parts}

    def reset(self) -> None:
        """Every dataset counts as deleted; their files stay until the folder is cleaned."""
        for r in self.datasets().select("name").collect():
            self.delete(r["name"])

    def delete(self, name: str) -> None:
        entry = self.metadata(name)
        if entry is not None:
            self._append(**{k: entry[k] for k in ("path", "stage", "rows", "content")}, name=name, written=datetime.now(UTC).replace(tzinfo=None), deleted=True)
