"""Exact nearest neighbours by blocked matrix products, candidates and imputation from them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.scratch import Scratch

#: Rows of a block at least and at most. Two blocks and the product of a slice of them are all that a task holds.
BLOCK, LARGEST = 8_192, 131_072


def exact_top_k(queries: DataFrame, items: DataFrame, key: str, vector: str, k: int, block: int = BLOCK) -> DataFrame:
    """(query, item, similarity): the k items of the highest cosine for each query, the smaller key first of equals.

    A query that is itself an item finds itself. Vectors that are null or of zero length take no part; all others must
    have one dimension. Rows are cut into blocks by a hash of the key, so no block depends on the distribution of keys;
    each pair of blocks is one matrix product, and a task returns at most k rows for each of its queries.
    """
    scratch = Scratch(queries.sparkSession, "exact-knn")
    usable = lambda df: df.where(F.col(vector).isNotNull() & F.exists(vector, lambda x: x != 0)).select(F.col(key).cast("string").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    q, x = scratch.save(usable(queries)), scratch.save(usable(items))
    rows_q, rows_x = q.count(), x.count()
    block = max(block, min(LARGEST, max(rows_q, rows_x) // 24))  # a row goes to as many tasks as the other side has blocks
    nq, nx = (max(1, -(-n // block)) for n in (rows_q, rows_x))
    number = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    left = q.select("id", "v", F.explode(F.transform(F.sequence(F.lit(0), F.lit(nx - 1)), lambda j: number(nq) * nx + j)).alias("cell"), F.lit(True).alias("asks"))
    right = x.select("id", "v", F.explode(F.transform(F.sequence(F.lit(0), F.lit(nq - 1)), lambda i: i * nx + number(nx))).alias("cell"), F.lit(False).alias("asks"))

    def product(part: pa.Table) -> pa.Table:
        asks = part["asks"].to_numpy().astype(bool)
        ids = np.array(part["id"].to_pylist(), object)
        values = part["v"].combine_chunks()
        values = values if isinstance(values, pa.Array) else pa.concat_arrays(values.chunks)
        v = values.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        v = v / np.linalg.norm(v, axis=1, keepdims=True)
        order = np.argsort(ids[~asks])
        names, found = ids[~asks][order], v[~asks][order]
        out_q, out_x, out_s = [], [], []
        asked = np.flatnonzero(asks)
        step = max(16, 4_000_000 // max(1, len(found)))
        for at in range(0, len(asked) if len(found) else 0, step):
            rows = asked[at : at + step]
            s = v[rows] @ found.T
            # stable sorting of the rounded values keeps the smaller key first of equals
            best = np.argsort(-np.round(s, 12), axis=1, kind="stable")[:, :k]
            out_q += np.repeat(ids[rows], best.shape[1]).tolist()
            out_x += names[best.ravel()].tolist()
            out_s.append(np.take_along_axis(s, best, 1).ravel())
        return pa.table({"query": pa.array(out_q, pa.string()), "item": pa.array(out_x, pa.string()), "similarity": pa.array(np.concatenate(out_s) if out_s else [], pa.float64())})

    hits = left.unionByName(right).groupBy("cell").applyInArrow(product, "query string, item string, similarity double")
    order = Window.partitionBy("query").orderBy(F.desc(F.round("similarity", 12)), "item")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def candidates(top: DataFrame, threshold: float) -> DataFrame:
    """(hash1, hash2, similarity) from a top-k: the limit came first, then the threshold, then the query itself is left out."""
    return top.where((F.col("similarity") >= threshold) & (F.col("query") != F.col("item"))).select(F.col("query").alias("hash1"), F.col("item").alias("hash2"), "similarity")


def record_candidates(pairs: DataFrame, records: DataFrame, record: str, person: str, every: bool = False) -> DataFrame:
    """Candidate records: every record of hash1 with the smallest (or with every=True each) record that has hash2."""
    left = records.select(F.col(record).alias("record1_id"), F.col(person).alias("hash1"))
    right = records.select(F.col(record).alias("record2_id"), F.col(person).alias("hash2")) if every else records.groupBy(F.col(person).alias("hash2")).agg(F.min(record).alias("record2_id"))
    return pairs.join(left, "hash1").join(right, "hash2", "left" if not every else "inner").select("record1_id", F.col("hash1").alias("record1_hash"), F.col("hash2").alias("record2_hash"), "similarity", "record2_id")


def impute_nearest(top: DataFrame, values: DataFrame, threshold: float) -> DataFrame:
    """(query, value, similarity): the most frequent value among the neighbours above the threshold, the nearest of equals."""
    near = top.where(F.col("similarity") >= threshold).join(values, "item")
    votes = near.groupBy("query", "value").agg(F.count(F.lit(1)).alias("votes"), F.min("rank").alias("rank"), F.max("similarity").alias("similarity"))
    best = votes.groupBy("query").agg(F.max_by(F.struct("value", "votes", "similarity"), F.struct("votes", -F.col("rank"))).alias("b"))
    return best.select("query", "b.*")


def impute_vector(top: DataFrame, items: DataFrame, key: str, vector: str, threshold: float, weighted: bool) -> DataFrame:
    """(query, position, value): mean of the neighbours' vectors, weighted by similarity if asked for, element by element."""
    near = top.where(F.col("similarity") >= threshold).join(items.select(F.col(key).cast("string").alias("item"), F.col(vector).alias("v")), "item")
    w = F.col("similarity") if weighted else F.lit(1.0)
    long = near.select("query", w.alias("w"), F.posexplode("v").alias("position", "x"))
    return long.groupBy("query", "position").agg((F.sum(F.col("w") * F.col("x").cast("double")) / F.sum("w")).alias("value"))
