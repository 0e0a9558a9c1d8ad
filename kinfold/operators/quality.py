"""Statistics of numeric columns, clusters and stages."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators.skew import lookup_join

# Upper bounds of sizes and their names; fixed values.
BUCKETS = ((1, "1"), (5, "2-5"), (10, "6-10"), (20, "11-20"), (50, "21-50"))


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])).alias("x")).select("x.*")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, count, mean, std, min, q25, q50, q75, max), exact quantiles, sample deviation; one pass over all columns.

    Quantiles are taken of the distinct values with their counts, so equal values, as of features that are mostly 0 or 1, cost one row.
    """
    rows = long_form(df, columns)
    q = F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    quantiles = rows.where("value IS NOT NULL").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")).groupBy("feature").agg(q.alias("q"))
    out = rows.groupBy("feature").agg(F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")).join(quantiles, "feature", "left")
    return out.select("feature", "count", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature1, feature2, r) for each pair of columns in order, 0 where a column is constant. All pairs are aggregates of one pass."""
    pairs = list(combinations(columns, 2))
    x = {c: F.col(c).cast("double") for c in columns}
    stats = df.agg(*[F.covar_pop(x[a], x[b]).alias(f"c{i}") for i, (a, b) in enumerate(pairs)], *[F.stddev_pop(x[c]).alias(f"s_{c}") for c in columns])
    rows = [F.struct(F.lit(a).alias("feature1"), F.lit(b).alias("feature2"), F.when((F.col(f"s_{a}") > 1e-12) & (F.col(f"s_{b}") > 1e-12), F.col(f"c{i}") / (F.col(f"s_{a}") * F.col(f"s_{b}"))).otherwise(0.0).alias("r")) for i, (a, b) in enumerate(pairs)]
    return stats.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def label_correlations(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(feature, importance): absolute correlation with the label."""
    x = correlations_with(df, columns, label)
    return x.select("feature", F.abs("r").alias("importance"))


def correlations_with(df: DataFrame, columns: Sequence[str], other: str) -> DataFrame:
    y = F.col(other).cast("double")
    stats = df.agg(F.stddev_pop(y).alias("__y"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("c", lambda c: F.covar_pop(F.col(c).cast("double"), y)), ("s", F.stddev_pop))])
    rows = [F.struct(F.lit(c).alias("feature"), F.when((F.col("__y") > 1e-12) & (F.col(f"s_{c}") > 1e-12), F.col(f"c_{c}") / (F.col("__y") * F.col(f"s_{c}"))).otherwise(0.0).alias("r")) for c in columns]
    return stats.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def constant_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return long_form(df, columns).groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high")).where(F.col("low").eqNullSafe(F.col("high"))).select("feature")


def low_variance(df: DataFrame, columns: Sequence[str], deviation: float = 0.01, spread: float = 0.1) -> DataFrame:
    stats = long_form(df, columns).groupBy("feature").agg(F.stddev_pop("value").alias("std"), (F.max("value") - F.min("value")).alias("range"))
    return stats.where((F.col("std") < deviation) & (F.col("range") < spread))


def non_finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return long_form(df, columns).groupBy("feature").agg(F.count_if(F.isnan("value")).alias("nan_values"), F.count_if(F.abs("value") == float("inf")).alias("infinite_values"))


def outliers(df: DataFrame, key: str, columns: Sequence[str], most: float = 3.0) -> DataFrame:
    """(key, outlying): rows with a feature more than `most` sample deviations off the mean, and how many."""
    stats = F.broadcast(df.agg(*[f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))]))
    z = [F.coalesce((F.abs((F.col(c) - F.col(f"__m_{c}")) / F.when(F.col(f"__s_{c}") > 1e-12, F.col(f"__s_{c}"))) > most).cast("int"), F.lit(0)) for c in columns]
    total = z[0]
    for x in z[1:]:
        total = total + x
    return df.crossJoin(stats).select(key, total.alias("outlying")).where("outlying > 0")


def duplicate_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"), F.round(1 - F.count(F.lit(1)) / F.sum("n"), 6).alias("duplicate_share"))


def cluster_sizes(clusters: DataFrame, cluster: str) -> DataFrame:
    return clusters.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))


def cluster_statistics(sizes: DataFrame, nodes: int | None = None) -> DataFrame:
    """One row of size statistics. Quantiles are exact, over the histogram of sizes."""
    q = F.percentile("size", F.array(*[F.lit(x) for x in (0.1, 0.25, 0.5, 0.75, 0.9)]))
    out = sizes.agg(F.count(F.lit(1)).alias("clusters"), F.sum("size").alias("members"), F.min("size").alias("smallest"), F.max("size").alias("largest"), F.avg("size").alias("mean"), F.stddev_pop("size").alias("std"), q.alias("q"), F.count_if(F.col("size") == 1).alias("singletons"))
    out = out.select("clusters", "members", "smallest", "largest", "mean", "std", *[F.col("q")[k].alias(n) for k, n in enumerate(("q10", "q25", "median", "q75", "q90"))], "singletons")
    return out if nodes is None else out.withColumn("coverage", F.col("members") / nodes)


def size_buckets(sizes: DataFrame) -> DataFrame:
    bucket = F.lit("51+")
    for most, name in reversed(BUCKETS):
        bucket = F.when(F.col("size") <= most, name).otherwise(bucket)
    return sizes.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("clusters"), F.sum("size").alias("members"))


def largest_clusters(sizes: DataFrame, cluster: str, n: int = 10) -> DataFrame:
    return sizes.orderBy(F.desc("size"), cluster).limit(n)


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """The total is one row of its own aggregate, so no window gathers all rows."""
    return df.crossJoin(F.broadcast(df.agg(F.sum(value).alias("__total")))).withColumn(name, F.coalesce(F.try_divide(F.col(value), F.col("__total")), F.lit(0.0))).drop("__total")


def trailing_mean(df: DataFrame, group: str, order: list[str], value: str, rows: int = 10) -> DataFrame:
    """Mean over the row and the rows - 1 before it within its group."""
    return df.withColumn("trailing_mean", F.avg(value).over(Window.partitionBy(group).orderBy(*order).rowsBetween(-(rows - 1), 0)))


def rate_window(df: DataFrame, group: str, time: str, value: str, seconds: int = 60) -> DataFrame:
    """Sum of `value` over the last `seconds` up to each row of its group: what a sliding rate limit compares."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    w = Window.partitionBy(group).orderBy(at).rangeBetween(-seconds * 1_000_000, 0)
    return df.withColumn("within_window", F.sum(value).over(w)).withColumn("events_within", F.count(F.lit(1)).over(w))


def throughput(stages: DataFrame, group: str, records: str, started: str, ended: str) -> DataFrame:
    """(group, records, seconds, per_second)."""
    s = stages.groupBy(group).agg(F.sum(records).alias("records"), F.min(started).alias("a"), F.max(ended).alias("b"))
    seconds = (F.unix_micros(F.col("b").cast("timestamp")) - F.unix_micros(F.col("a").cast("timestamp"))) / 1e6
    return s.select(group, "records", seconds.alias("seconds"), F.coalesce(F.try_divide(F.col("records"), seconds), F.lit(0.0)).alias("per_second"))


def principal_components(df: DataFrame, key: str, vector: str, k: int = 2) -> DataFrame:
    """(key, c1..ck): projection on the first principal components. The covariance is aggregated; only its matrix reaches the driver."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.where(F.col(vector).isNotNull()).select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("__x"))
    out = PCA(k=k, inputCol="__x", outputCol="__c").fit(rows).transform(rows).withColumn("__c", vector_to_array("__c"))
    return out.select(key, *[F.col("__c")[i].alias(f"c{i + 1}") for i in range(k)])


def large_enough(clusters: DataFrame, cluster: str, least: int, singletons: bool = False) -> DataFrame:
    """Clusters of at least `least` members; with singletons=True those of one member stay too. Sizes are aggregated, and looked up without putting a large cluster into one task."""
    if least <= 1:
        return clusters
    sizes = clusters.groupBy(cluster).agg(F.count(F.lit(1)).alias("__members"))
    keep = F.col("__members") >= least
    kept = sizes.where(keep | (F.col("__members") == 1) if singletons else keep)
    return lookup_join(clusters, kept, [cluster], next(c for c in clusters.columns if c != cluster), how="inner").drop("__members")


def cluster_of(clusters: DataFrame, entity: str, cluster: str, asked: DataFrame) -> DataFrame:
    """All members of the clusters of the entities asked for (a column named like `entity`)."""
    wanted = clusters.join(asked.select(entity).distinct(), entity, "left_semi").select(cluster).distinct()
    return clusters.join(wanted, cluster, "left_semi").select(*clusters.columns)


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, min, max, mean, std): of each column and of all values together, under the name all; population deviation."""
    x = long_form(df, columns)
    stats = [F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")]
    return x.groupBy("feature").agg(*stats).unionByName(x.agg(F.lit("all").alias("feature"), *stats))


def inspect(df: DataFrame) -> DataFrame:
    """(column, rows, nulls, distinct_values, shortest, longest) of every column, as text."""
    x = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns])).alias("x")).select("x.*")
    # counted by value first, so a value on a third of the rows is one row
    by = x.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return by.groupBy("column").agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0).cast("bigint")).alias("nulls"), F.count("value").alias("distinct_values"), F.min(F.length("value")).alias("shortest"), F.max(F.length("value")).alias("longest"))


def in_stage_order(df: DataFrame, stage: str, order: Sequence[str]) -> DataFrame:
    """Adds `place`: stages in the given order, unknown ones behind them by name. For reports: one row a stage."""
    at = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(stage))
    return df.withColumn("place", F.row_number().over(Window.orderBy(F.when(at == 0, len(order) + 1).otherwise(at), stage)))


def placed(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds `place` by descending value, equals by name. For reports: one row a field."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(F.desc(value), name)))
