"""Delivered files: catalogue CSV directories and labelled pairs in their formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = ("personId", "composite", "person", "roles", "title", "provision", "subjects")
CATALOG = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
_CORRUPT = "_corrupt"


def _files(path: str) -> str:
    return path if path.endswith(".csv") or "*" in path else f"{path.rstrip('/')}/*.csv"


def _headers(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header line: the driver sees one line a file, none of the rows."""
    first = spark.read.option("multiLine", True).option("escape", '"')
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        if (row := first.csv(f).first()) is not None:
            groups.setdefault(tuple((c or "").strip().lstrip("\ufeff") for c in row), []).append(f)
    return groups


def _parsed(spark: SparkSession, path: str, done: DataFrame | None = None) -> DataFrame:
    """All rows of all files with their file and, where a row does not fit its file's header, the row as it stands in _corrupt."""
    files = spark.read.format("binaryFile").load(_files(path)).select("path")
    if done is not None:
        files = files.join(done.select(F.col("file").alias("path")).distinct(), "path", "left_anti")
    out = None
    for header, names in sorted(_headers(spark, [r["path"] for r in files.collect()]).items()):
        lacking = [c for c in COLUMNS[:5] if c not in header]
        if lacking:
            raise ValueError(f"columns missing from {names[0]}: {lacking}")
        # a name that occurs twice is read once, from where it stands first
        unique = [c if c and header.index(c) == i else f"__{i}" for i, c in enumerate(header)]
        schema = T.StructType([*[T.StructField(c, T.StringType()) for c in unique], T.StructField(_CORRUPT, T.StringType())])
        rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).schema(schema).csv(names)
        rows = rows.select("*", F.col("_metadata.file_path").alias("file"))
        # naming every column keeps the parser from skipping the others
        whole = F.length(F.concat_ws("", *unique)) >= 0
        rows = rows.where(whole).select(*[F.col(c) if c in header else F.lit(None).cast("string").alias(c) for c in COLUMNS], F.col("file"), F.col(_CORRUPT))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        empty = T.StructType([*CATALOG.fields, T.StructField("file", T.StringType()), T.StructField(_CORRUPT, T.StringType())])
        return spark.createDataFrame([], empty)
    return out


def read_catalog(spark: SparkSession, path: str, done: DataFrame | None = None) -> DataFrame:
    """(personId, ..., subjects, file): all rows of a directory of CSV files with a header, as nullable strings.

    Columns are found by their name in each file, so files may hold others and in any order, each file in its own; a missing optional
    column is null. Rows that do not fit their header are kept out: `malformed_rows` has them. `done` (file) lists files to leave
    out, as those of an earlier run. Files of the same header are one scan.
    """
    return _parsed(spark, path, done).where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def malformed_rows(spark: SparkSession, path: str, done: DataFrame | None = None) -> DataFrame:
    """(file, row): rows that do not fit the header of their file. A quoted value may hold line breaks."""
    return _parsed(spark, path, done).where(F.col(_CORRUPT).isNotNull()).select("file", F.col(_CORRUPT).alias("row"))


def read_labels(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(left_id, right_id, is_match string): labelled pairs.

    kind: "csv" (header left,right,match), "bare" (CSV without header), "list" (JSON list of objects left, right, match),
    "dict" (one JSON object of "a|b": label), "strict" (as "csv", where only "true" is a match). JSON booleans and numbers come out as their text.
    """
    if kind == "csv":
        rows = spark.read.option("header", True).schema("left string, right string, match string").csv(path)
        return rows.toDF("left_id", "right_id", "is_match")
    if kind == "bare":
        return spark.read.schema("left_id string, right_id string, is_match string").csv(path)
    if kind == "list":
        return spark.read.option("multiLine", True).option("primitivesAsString", True).schema("left string, right string, match string").json(path).toDF("left_id", "right_id", "is_match")
    if kind == "strict":
        # only the word true is a match, whatever its case; every other label is none
        rows = spark.read.option("header", True).schema("left string, right string, match string").csv(path)
        return rows.select(F.col("left").alias("left_id"), F.col("right").alias("right_id"), F.when(F.lower(F.trim("match")) == "true", "true").otherwise("false").alias("is_match"))
    if kind == "dict":
        whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("pair", "is_match"))
        parts = F.split("pair", r"\|")
        return whole.where(F.size(parts) == 2).select(parts[0].alias("left_id"), parts[1].alias("right_id"), "is_match")
    raise ValueError(f"unknown kind {kind!r}")
