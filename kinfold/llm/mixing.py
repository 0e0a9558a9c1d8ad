"""Mixing sources to target weights along a curriculum of weight schedules."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.tokens import VOCABULARY, with_sizes
from kinfold.operators.skew import ranked
from kinfold.scratch import Scratch

Schedule = list[tuple[float, float]]


def default_schedules(shares: dict[str, float], passes: dict[str, float], strength: float = 0.5) -> dict[str, Schedule]:
    """Straight lines over training time 0..1 whose mean is the source's share: sources that repeat come in later.

    The slopes weigh out to nothing over all sources, so weights add up to 1 at any time, and `strength` < 1 keeps them positive.
    """
    mean = sum(shares[s] * passes[s] for s in shares)
    far = max((abs(passes[s] - mean) for s in shares), default=0) or 1.0
    return {s: [(0.0, w * (1 - strength * (passes[s] - mean) / far)), (1.0, w * (1 + strength * (passes[s] - mean) / far))] for s, w in shares.items()}


def demand(schedule: Schedule, t: np.ndarray) -> np.ndarray:
    """Integral of the schedule from 0 to t."""
    x, w = np.array(schedule, float).T
    area = np.concatenate([[0.0], np.cumsum((w[1:] + w[:-1]) / 2 * np.diff(x))])
    k = np.clip(np.searchsorted(x, t, "right") - 1, 0, len(x) - 2)
    slope = (w[k + 1] - w[k]) / (x[k + 1] - x[k])
    return area[k] + (t - x[k]) * (w[k] + slope * (t - x[k]) / 2)


def position(schedule: Schedule, part: np.ndarray) -> np.ndarray:
    """Inverse of `demand`: the time at which the given part (0..1) of the source's whole demand is due."""
    x, w = np.array(schedule, float).T
    area = np.concatenate([[0.0], np.cumsum((w[1:] + w[:-1]) / 2 * np.diff(x))])
    due = np.clip(part, 0, 1) * area[-1]
    k = np.clip(np.searchsorted(area, due, "right") - 1, 0, len(x) - 2)
    slope = (w[k + 1] - w[k]) / (x[k + 1] - x[k])
    rest = due - area[k]
    # w t + slope t^2 / 2 = rest, in the form that stays exact for small slopes
    root = np.sqrt(np.maximum(w[k] ** 2 + 2 * slope * rest, 0))
    step = 2 * rest / np.maximum(w[k] + root, 1e-300)
    return np.clip(x[k] + step, x[k], x[k + 1])


def mix(documents: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", schedules: dict[str, Schedule] | None = None, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(mixture, shares).

    mixture (position, key, source, pass_no, n_tokens), in order of position: a training order in which each source has
    its target share of all tokens over the whole and follows its weight schedule along the way. No document is used
    more than the source's max_repeats times; all documents of a source are used once before any is used again.
    shares (source, target_share, max_repeats, available_tokens, used_tokens, uses, passes, actual_share): one row for
    each target.

    The mixture is the longest for which every source with documents reaches its target. Targets without tokens stay at 0
    and the others share in proportion. Documents are never cut: a source's last document is used if more than half of it is
    due. Documents without a target, with null source or without tokens are not part of the mixture. Repeated target
    rows count once; of several for a source the first by share and repeats holds. Empty tables give empty results.
    """
    scratch = Scratch(documents.sparkSession, "mixing")
    sized = scratch.save(with_sizes(documents.where(F.col(source).isNotNull()), [key, source], text, "n_tokens", vocabulary)).where("n_tokens > 0")
    wanted = targets.where("source IS NOT NULL AND target_share > 0 AND max_repeats > 0").groupBy("source").agg(F.min(F.struct("target_share", "max_repeats")).alias("t")).select(F.col("source").alias("name"), "t.*")
    available = sized.groupBy(source).agg(F.sum("n_tokens").alias("available_tokens"), F.count(F.lit(1)).alias("documents"))
    # one row for each target: a table of sources, whose number the targets bound
    rows = wanted.join(available, F.col("name") == F.col(source), "left").select("name", "target_share", "max_repeats", F.coalesce("available_tokens", F.lit(0)).alias("available_tokens"), F.coalesce("documents", F.lit(0)).alias("documents")).toPandas()
    live = rows[rows.available_tokens > 0]
    whole = float(live.target_share.sum())
    shares = {r.name: r.target_share / whole for r in live.itertuples()}
    length = min((r.available_tokens * r.max_repeats / shares[r.name] for r in live.itertuples()), default=0.0)
    due = {s: length * w for s, w in shares.items()}
    passes = {r.name: due[r.name] / r.available_tokens for r in live.itertuples()}
    schedules = {**default_schedules(shares, passes), **(schedules or {})}
    spark = documents.sparkSession
    plan = [(r.name, float(due[r.name]), int(min(r.max_repeats, np.ceil(passes[r.name] - 1e-9))), int(r.available_tokens)) for r in live.itertuples()]
    plan_df = spark.createDataFrame(plan, "__s string, __due double, __passes int, __available bigint")
    uses = sized.join(F.broadcast(plan_df), F.col(source) == F.col("__s"), "inner").withColumn("pass_no", F.explode(F.sequence(F.lit(1), F.col("__passes"))))
    n = int(sum(p[2] * int(live.set_index("name").documents[p[0]]) for p in plan))
    ordered = ranked(uses, [source, "pass_no"], ["pass_no", key], "__rank", running=("n_tokens", "__before"), total=n)
    middle = (F.col("pass_no") - 1) * F.col("__available") + F.col("__before") + F.col("n_tokens") / 2

    @F.pandas_udf("double")
    def when(name: pd.Series, part: pd.Series) -> pd.Series:
        out = np.empty(len(part))
        values, names = part.to_numpy(float), name.to_numpy(object)
        for s in set(names):
            here = names == s
            out[here] = position(schedules[s], values[here])
        return pd.Series(out)

    used = ordered.withColumn("__middle", middle).where(F.col("__middle") <= F.col("__due"))
    used = scratch.save(used.select(when(source, F.col("__middle") / F.col("__due")).alias("position"), key, source, "pass_no", "n_tokens"))
    mixture = used.orderBy("position", source, key, "pass_no")
    got = used.groupBy(source).agg(F.sum("n_tokens").alias("used_tokens"), F.count(F.lit(1)).alias("uses"), F.max("pass_no").alias("passes"))
    everything = got.agg(F.sum("used_tokens").alias("__everything"))
    targets_df = spark.createDataFrame([(r.name, float(r.target_share), int(r.max_repeats), int(r.available_tokens)) for r in rows.itertuples()], "source string, target_share double, max_repeats int, available_tokens bigint")
    got = got.withColumnRenamed(source, "source") if source != "source" else got
    report = targets_df.join(F.broadcast(got), "source", "left").crossJoin(F.broadcast(everything)).select(
        "source", "target_share", "max_repeats", "available_tokens",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("used_tokens", "uses", "passes")],
        F.coalesce(F.col("used_tokens") / F.col("__everything"), F.lit(0.0)).alias("actual_share"),
    )
    return mixture, report
