"""Sizes in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import os
from functools import lru_cache
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import tiktoken

#: Vocabulary of byte-level tokens as ranks, one base64 token and its rank on each line.
VOCABULARY = os.environ.get("KINFOLD_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: The split pattern that belongs to that vocabulary; fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoding(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding and the byte length of each token."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def count_tokens(text: str | None, path: str) -> int:
    return len(encoding(path)[0].encode_to_numpy(text, disallowed_special=())) if text else 0


def token_count(column: str, path: str = VOCABULARY) -> Column:
    """Tokens of the whole text; 0 for null and empty text."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([count_tokens(t, path) for t in texts], dtype="int64")

    return count(F.col(column))


def with_sizes(documents: DataFrame, columns: list[str], text: str = "text", size: str = "n_tokens", path: str = VOCABULARY) -> DataFrame:
    """`columns` and the size of each text. Texts are counted where they are read."""
    return documents.select(*columns, token_count(text, path).alias(size))
