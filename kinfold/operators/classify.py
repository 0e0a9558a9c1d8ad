"""Matcher: split, standardization, logistic regression, scores and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators.skew import ranked

#: Ranges that scores are cut into for running sums.
BUCKETS = 256


def stratified_split(df: DataFrame, key: str, label: str, train_share: float = 0.7) -> DataFrame:
    """Adds `part` (train or test): of each label the given share of rows, by a hash of the key, so the same on each run. Ranks are made over ranges of the hash, so a label may hold nearly all rows."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__size"))
    placed = ranked(df, [label], [key], "__rank").join(F.broadcast(sizes), label)
    return placed.withColumn("part", F.when(F.col("__rank") < F.floor(F.col("__size") * train_share), "train").otherwise("test")).drop("__rank", "__size")


def standardize(df: DataFrame, features: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """(x - mean) / population deviation, of the rows `fit_on`; a constant feature is only centred. Statistics are one row."""
    source = df.where(fit_on) if fit_on is not None else df
    stats = source.agg(*[f(c).alias(f"__{n}_{c}") for c in features for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    scaled = df.crossJoin(F.broadcast(stats))
    return scaled.select(*[c for c in df.columns if c not in features], *[((F.col(c) - F.col(f"__m_{c}")) / F.when(F.col(f"__s_{c}") > 1e-12, F.col(f"__s_{c}")).otherwise(1.0)).alias(c) for c in features])


def train_logistic(df: DataFrame, features: Sequence[str], label: str, strength: float = 1.0, max_iter: int = 1000, tol: float = 1e-4):
    """L2 logistic regression with balanced class weights and an unpenalised intercept; C = 1 / strength. Returns (coefficients, intercept).

    Raises ValueError if only one class occurs: no synthetic rows are made up.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if len(sizes) != 2:
        raise ValueError(f"two classes are needed, got {sorted(sizes)}")
    n = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for k, size in sizes.items():
        weight = F.when(F.col(label) == k, n / (2 * size)).otherwise(weight)
    data = VectorAssembler(inputCols=list(features), outputCol="__x").transform(df.withColumn("__w", weight).withColumn("__y", F.col(label).cast("double")))
    model = LogisticRegression(featuresCol="__x", labelCol="__y", weightCol="__w", regParam=strength / n, elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol).fit(data)
    return [float(c) for c in model.coefficients], float(model.intercept)


def select_features(df: DataFrame, features: Sequence[str], label: str, keep_share: float = 0.2, least: int = 5, step: int = 1) -> list[tuple[str, int]]:
    """Recursive elimination: (feature, rank), 1 for those kept; the smallest absolute coefficient goes first."""
    left, ranks = list(features), {}
    target = max(least, int(keep_share * len(features)))
    gone: list[list[str]] = []
    while len(left) > target:
        coefficients, _ = train_logistic(df, left, label)
        order = sorted(range(len(left)), key=lambda k: (abs(coefficients[k]), left[k]))[: min(step, len(left) - target)]
        gone.append([left[k] for k in order])
        left = [f for k, f in enumerate(left) if k not in order]
    ranks = dict.fromkeys(left, 1) | {f: len(gone) - i + 1 for i, fs in enumerate(gone) for f in fs}
    return sorted(ranks.items(), key=lambda x: (x[1], x[0]))


def score(df: DataFrame, weights: dict[str, float], intercept: float, threshold: float = 0.9) -> DataFrame:
    """Adds probability and prediction of a linear model; plain columns, so scoring stays in the JVM."""
    z = F.lit(float(intercept))
    for f, w in weights.items():
        z = z + F.lit(float(w)) * F.col(f)
    p = 1 / (1 + F.exp(-z))
    return df.withColumn("probability", p).withColumn("prediction", (p >= threshold).cast("int"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"), F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))


def metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1, accuracy, FPR and FNR from a confusion row; 0 where a denominator is 0."""
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision, recall = share(tp, tp + fp), share(tp, tp + fn)
    return counts.select("tp", "fp", "tn", "fn", precision.alias("precision"), recall.alias("recall"), share(2 * precision * recall, precision + recall).alias("f1"), share(tp + tn, tp + fp + tn + fn).alias("accuracy"), share(fp, fp + tn).alias("fpr"), share(fn, fn + tp).alias("fnr"))


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, p, q, bucket): positives and negatives of each score; buckets are ranges of scores with about equally many distinct ones.

    A matcher's scores crowd at 0 and 1, so the bounds are quantiles of the counted scores, not equal widths.
    """
    by_score = df.groupBy(F.col(score).alias("threshold")).agg(F.sum(label).alias("p"), F.sum(1 - F.col(label)).alias("q"))
    bounds = by_score.agg(F.percentile_approx("threshold", [i / BUCKETS for i in range(1, BUCKETS)], 10_000).alias("__bounds"))
    crossed = by_score.crossJoin(F.broadcast(bounds))  # one row of bounds
    return crossed.withColumn("bucket", F.size(F.filter(F.coalesce("__bounds", F.array().cast("array<double>")), lambda x: x < F.col("threshold")))).drop("__bounds")


def _cumulative(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, tp, fp, positives, negatives, p, q, bucket) by descending score. Rows are counted by score first; the running sums go over ranges of scores, so no task gets all of them."""
    by_score = _by_score(df, label, score)
    per = by_score.groupBy("bucket").agg(F.sum("p").alias("bp"), F.sum("q").alias("bq"))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("bucket", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"above_{c}") for c in ("bp", "bq")])  # at most BUCKETS rows
    within = Window.partitionBy("bucket").orderBy(F.desc("threshold"))
    total = by_score.agg(F.sum("p").alias("positives"), F.sum("q").alias("negatives"))
    out = by_score.join(F.broadcast(before), "bucket").crossJoin(F.broadcast(total))
    return out.select("threshold", (F.col("above_bp") + F.sum("p").over(within)).alias("tp"), (F.col("above_bq") + F.sum("q").over(within)).alias("fp"), "positives", "negatives", "p", "q", "bucket")


def precision_recall_area(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """One row (points, area, mean_precision): the area under the precision-recall curve by trapezoids, from recall 0 at precision 1 on."""
    c = _cumulative(df, label, score).select("threshold", "bucket", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.coalesce(F.try_divide("tp", "positives"), F.lit(0.0)).alias("recall"))
    # the point before the first of a range is the last of the range above
    ends = c.groupBy("bucket").agg(F.min_by(F.struct("precision", "recall"), "threshold").alias("end"))
    above = ends.select("bucket", F.lag("end").over(Window.orderBy(F.desc("bucket"))).alias("above"))  # at most BUCKETS rows
    within = Window.partitionBy("bucket").orderBy(F.desc("threshold"))
    c = c.join(F.broadcast(above), "bucket").withColumn("last", F.coalesce(F.lag(F.struct("precision", "recall")).over(within), "above"))
    height, width = F.col("precision") + F.coalesce("last.precision", F.lit(1.0)), F.col("recall") - F.coalesce("last.recall", F.lit(0.0))
    return c.agg(F.count(F.lit(1)).alias("points"), F.coalesce(F.sum(width * height / 2), F.lit(0.0)).alias("area"), F.coalesce(F.avg("precision"), F.lit(0.0)).alias("mean_precision"))


def against_expected(counts: DataFrame, expected: dict[str, int]) -> DataFrame:
    """(cell, expected, actual, difference) of a confusion row."""
    cells = [F.struct(F.lit(c).alias("cell"), F.lit(n).cast("bigint").alias("expected"), F.col(c).alias("actual"), (F.col(c) - n).alias("difference")) for c, n in expected.items()]
    return counts.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def coefficient_importance(model: DataFrame) -> DataFrame:
    """(feature, importance, share, largest, smallest, mean, std): absolute coefficients of a model (feature, coefficient) without its intercept."""
    m = model.where("feature <> 'intercept'").select("feature", F.abs("coefficient").alias("importance"))
    stats = m.agg(F.sum("importance").alias("total"), F.max("importance").alias("largest"), F.min("importance").alias("smallest"), F.avg("importance").alias("mean"), F.stddev_pop("importance").alias("std"))
    return m.crossJoin(F.broadcast(stats)).select("feature", "importance", F.coalesce(F.try_divide("importance", "total"), F.lit(0.0)).alias("share"), "largest", "smallest", "mean", "std")


def validate(df: DataFrame, features: Sequence[str], label: str) -> None:
    """Raises ValueError where a matcher cannot be fitted: columns missing, no rows, one class, labels other than 0 and 1, or values that are null, NaN or infinite."""
    lacking = [c for c in [*features, label] if c not in df.columns]
    if lacking:
        raise ValueError(f"columns missing: {lacking}")
    bad = lambda c: F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf"))
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("ones"), F.count_if(F.col(label) == 0).alias("zeros"), *[F.count_if(bad(c)).alias(f"bad_{c}") for c in features]).first()
    if not row["rows"]:
        raise ValueError("no rows")
    if row["ones"] + row["zeros"] < row["rows"]:
        raise ValueError("labels other than 0 and 1")
    if not row["ones"] or not row["zeros"]:
        raise ValueError("two classes are needed")
    unusable = [c for c in features if row[f"bad_{c}"]]
    if unusable:
        raise ValueError(f"values that are null, NaN or infinite: {unusable}")


def roc_curve(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """(threshold, tpr, fpr), a point for each distinct score in 0..1."""
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return _cumulative(df, label, score).select("threshold", share("tp", "positives").alias("tpr"), share("fp", "negatives").alias("fpr"))


def precision_recall_curve(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    c = _cumulative(df, label, score)
    return c.select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.coalesce(F.try_divide(F.col("tp"), F.col("positives")), F.lit(0.0)).alias("recall"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """Share of positive-negative pairs in the right order, equal scores half. One row."""
    # negatives below a score: all of them less those at or above it
    got = _cumulative(df, label, score).agg(F.sum(F.col("p") * (F.col("negatives") - F.col("fp") + F.col("q") / 2)).alias("right"), F.max(F.col("positives") * F.col("negatives")).alias("pairs"))
    return got.select(F.coalesce(F.try_divide("right", "pairs"), F.lit(0.0)).alias("auc"))


def threshold_marker(curve: DataFrame, threshold: float) -> DataFrame:
    """The point of a curve whose threshold is nearest to the given one."""
    return curve.agg(F.min_by(F.struct(*curve.columns), F.struct(F.abs(F.col("threshold") - threshold), "threshold")).alias("m")).select("m.*")


def misclassified(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.where(F.col(label) != F.col(prediction)).withColumn("kind", F.when(F.col(label) == 1, "false_negative").otherwise("false_positive"))
