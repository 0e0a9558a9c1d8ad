"""python -m kinfold ROWS LABELS FOLDER: runs the pipeline over Parquet tables and prints what each stage did."""

from __future__ import annotations

import argparse

from kinfold.plans.pipeline import Config, Pipeline
from kinfold.session import get_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="kinfold")
    p.add_argument("rows", help="catalogue rows: Parquet, or a folder of CSV files")
    p.add_argument("labels", help="labelled pairs: Parquet")
    p.add_argument("folder", help="registry to write to")
    p.add_argument("--config", help="settings as a JSON or YAML file")
    p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="one setting; comes after the file")
    p.add_argument("--start", help="first stage")
    p.add_argument("--end", help="last stage")
    p.add_argument("--again", action="store_true", help="run completed stages too")
    p.add_argument("--go-on", action="store_true", help="go on after a failed stage")
    a = p.parse_args(argv)
    spark = get_session()
    config = (Config.load(a.config) if a.config else Config()).override_text(dict(x.split("=", 1) for x in a.set))
    if a.rows.rstrip("/").endswith(".parquet"):
        rows = spark.read.parquet(a.rows)
    else:
        from pyspark.sql import functions as F

        from kinfold.sources.readers import read_catalog

        # files have no time of their own: they arrive in the order of their names
        rows = read_catalog(spark, a.rows).withColumnRenamed("personId", "personid").withColumn("batch_no", F.lit(0)).withColumn("changed_at", F.col("file"))
    Pipeline(spark, a.folder, rows, spark.read.parquet(a.labels), config).run(a.start, a.end, a.again, not a.go_on).show(50, False)


if __name__ == "__main__":
    main()
