import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.llm.splitting import boundary_strengths, split_documents, split_text, token_starts
from kinfold.llm.tokens import VOCABULARY, count_tokens


def check(text, limit, overlap):
    pieces = split_text(text, limit, overlap)
    assert "".join(text[own if i else a : b] for i, (a, b, own, _) in enumerate(pieces)) == text
    starts = token_starts(text)
    for i, (a, b, own, n) in enumerate(pieces):
        assert n == count_tokens(text[a:b], VOCABULARY) <= limit and a <= own < b
        if i:
            back = np.searchsorted(starts, own) - np.searchsorted(starts, a)
            assert own == pieces[i - 1][1] and back >= min(overlap, np.searchsorted(starts, own))
    return pieces


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from(list("ab  ,.\n\n中é😀'")), max_size=400), st.integers(12, 40), st.integers(0, 5))
def test_round_trip(text, limit, overlap):
    check(text, limit, overlap)


def test_natural_cuts():
    rng = random.Random(1)
    paragraph = lambda: " ".join(f"{rng.choice(['Alpha', 'beta', 'gamma'])} {rng.choice(['runs', 'sits'])} here." for _ in range(12))
    text = "\n\n".join(paragraph() for _ in range(30))
    strength = boundary_strengths(text)
    pieces = check(text, 200, 20)
    assert all(strength[own] == 5 for _, _, own, _ in pieces[1:])
    sizes = [n for *_, n in pieces]
    assert min(sizes) > 0.4 * max(sizes)  # balanced, no crumb at the end


@pytest.mark.parametrize("text", ["a" * 5000, "中" * 3000, "😀" * 700, "x1" * 2000, " " * 4000, "é" * 900, "\n" * 3000])
def test_without_breaks(text):
    assert len(check(text, 64, 8)) >= 1


def test_strengths():
    s = boundary_strengths("One, two. Three\nfour\n\nfive\n\n# six 七。八")
    text = "One, two. Three\nfour\n\nfive\n\n# six 七。八"
    at = lambda w: s[text.index(w)]
    assert [at(w) for w in ("two", "Three", "four", "five", "# six", "six", "八")] == [2, 3, 4, 5, 6, 1, 3]
    assert s[0] == s[-1] == 0 and list(boundary_strengths("")) == [0]


def test_documents(spark):
    rows = [(1, "short"), (2, None), (None, "word " * 900), (4, ""), (1, "short"), (5, "word. " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("piece", F.lit(0)).withColumn("pieces", F.lit("x"))
    got = split_documents(df, 256, 32).collect()
    assert sum(r.doc_id == 1 for r in got) == 2 and {(r.piece_no, r.piece) for r in got if r.doc_id in (2, 4)} == {(0, "")}
    assert sum(r.doc_id is None for r in got) > 3
    assert split_documents(df.limit(0), 256, 32).count() == 0
    with pytest.raises(ValueError):
        split_documents(df, 100, 50)


def test_fewest_pieces():
    """Texts with breaks get few pieces more than their tokens need."""
    rng = random.Random(2)
    for n in (40, 400, 2000):
        text = "\n\n".join(" ".join(rng.choice(["Alpha runs here.", "beta sits,", "gamma"]) for _ in range(rng.randint(3, 40))) for _ in range(n))
        tokens = count_tokens(text, VOCABULARY)
        pieces = check(text, 200, 20)
        least = -(-(tokens - 20) // 180)
        assert len(pieces) <= least + max(1, 0.08 * least)
