"""Intermediate tables in the folder that all executors share.

Iterative operators cut their lineage by writing a table there. A table on shared storage survives the loss of any
executor, takes less room than serialized rows, and is read again with column pruning.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LEFTOVERS: dict[str, object] = {}


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _remove_leftovers() -> None:
    for path, spark in list(_LEFTOVERS.items()):
        try:
            _remove(spark, path)
        except Exception:  # the JVM may be gone by now
            pass


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; in local mode, and only there, a temporary one where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="kinfold-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Tables of one operator run. `save` writes a DataFrame and returns it as read back; `drop` removes it early.

    What the result still reads is removed when the Python process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        _LEFTOVERS[self.root] = spark

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def save_counted(self, df: DataFrame) -> tuple[DataFrame, int]:
        """The saved table and its rows, counted as they are written."""
        seen = Observation()
        out = self.save(df.observe(seen, F.count(F.lit(1)).alias("n")))
        return out, int(seen.get["n"])

    def drop(self, *tables: DataFrame) -> None:
        """Removes saved tables that nothing reads any more."""
        for df in tables:
            _remove(self.spark, df._scratch_path)
