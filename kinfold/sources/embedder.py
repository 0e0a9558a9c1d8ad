"""Vectors for strings: a pluggable embedder behind Arrow batches, with a deterministic offline default."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Takes texts, returns one row of floats for each.
Embedder = Callable[[list[str]], np.ndarray]


def hashing_embedder(dimensions: int = 64, q: int = 3) -> Embedder:
    """Signed hashing of q-grams, unit length; the same vector for the same text anywhere."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions), np.float32)
        for i, t in enumerate(texts):
            t = f"  {t.lower()}  "
            for k in range(len(t) - q + 1):
                h = zlib.crc32(t[k : k + q].encode("utf-8", "surrogatepass"))
                out[i, h % dimensions] += 1 if h & 0x8000_0000 else -1
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(length == 0, 1, length)

    return embed


def embed_strings(strings: DataFrame, key: str, value: str, embedder: Embedder | None = None, batch: int = 100, attempts: int = 3) -> DataFrame:
    """(key, v): each distinct string is embedded once, in batches, with retries after growing pauses, and the vector goes to every key that has it. Null strings have none."""
    import time

    embed = embedder or hashing_embedder()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            for at in range(0, len(texts), batch):
                part = texts[at : at + batch]
                for attempt in range(attempts):
                    try:
                        v = embed(part)
                        break
                    except Exception:
                        if attempt == attempts - 1:
                            raise
                        time.sleep(2**attempt)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array(list(v.astype(np.float32)), pa.list_(pa.float32()))], names=["__value", "v"])

    distinct = strings.where(F.col(value).isNotNull()).select(F.col(value).alias("__value")).distinct()
    vectors = distinct.mapInArrow(run, "__value string, v array<float>")
    return strings.where(F.col(value).isNotNull()).select(key, F.col(value).alias("__value")).join(vectors, "__value").select(key, "v")


def embed_text(text: str, embedder: Embedder | None = None) -> list[float]:
    """The vector of one string, the same as `embed_strings` gives it."""
    return [float(x) for x in (embedder or hashing_embedder())([text])[0]]


def vector_of(vectors: DataFrame, key: str, value: str, vector: str = "v") -> list[float] | None:
    """The stored vector of one key, None where there is none: a filter that reaches the scan."""
    row = vectors.where(F.col(key) == value).select(vector).first()
    return None if row is None else row[0]
