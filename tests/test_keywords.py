"""Many words at once against plain search."""

from __future__ import annotations

import random
from functools import reduce

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataloom.functions import keywords
from strataloom.operators import enrich


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abé铁", min_size=1, max_size=5), min_size=1, max_size=10), st.lists(st.text("abé铁 ", max_size=40), max_size=8), st.sampled_from([3, 7, 1024]))
def test_automaton(words, texts, piece):
    """Pieces of any size, words in words, and texts that end in one."""
    before, keywords.PIECE = keywords.PIECE, piece
    try:
        built = keywords.automata(words)
        for _, raw, off in keywords._texts(pa.array(texts, pa.string())):
            first = reduce(np.minimum, [a.first(raw, off) for a in built])
            assert first.tolist() == [min((i for i, w in enumerate(words) if w in t), default=keywords.NONE) for t in texts]
            row, word = built[0].all(raw, off)
            assert list(zip(row.tolist(), word.tolist(), strict=True)) == [(r, i) for r, t in enumerate(texts) for i, w in enumerate(words) if w in t]
    finally:
        keywords.PIECE = before


def test_words_of_many_automata(monkeypatch):
    monkeypatch.setattr(keywords, "TABLE", 40_000)
    words = [f"w{i}x" for i in range(200)]
    built = keywords.automata(words)
    assert len(built) > 10 and all(a.step.nbytes <= 40_000 for a in built)
    with pytest.raises(ValueError, match="too long"):
        keywords.automata(["x" * 40_000])


def test_two_thousand_words_equal_the_chains(spark):
    """any_of() and first_match() of a long table give what a search for each word gives; nulls match nothing."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(3, 9)))
    words = sorted({word() for _ in range(2_000)})
    texts = [None, "", "zzz", *(" ".join(word() for _ in range(rng.randint(0, 12))) for _ in range(300)), "zz" * 3_000 + words[7]]
    rules = {f"r{i}": words[i::50] for i in range(50)}
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").repartition(3)
    got = {r["n"]: (r["any"], r["rule"]) for r in df.select("n", enrich.any_of(F.col("t"), words).alias("any"), enrich.first_match(F.col("t"), rules, "none").alias("rule")).collect()}
    for n, t in enumerate(texts):
        assert got[n] == (any(w in (t or "") for w in words), next((r for r, own in rules.items() if any(w in (t or "") for w in own)), "none"))
    names = [w for w in words if len(w) > 5][:300]
    df = spark.createDataFrame([(f"x{a}y{b}z",) for a, b in zip(names, reversed(names), strict=True)], "a string")
    longest = lambda t: min((w for w in [*names, enrich.OTHER] if w in t), key=lambda w: (-len(w), w))
    assert all(r["n"] == longest(r["a"]) for r in df.select("a", enrich.named_in(F.col("a"), names).alias("n")).collect())


def test_empty_words(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,)], "t string")
    words = keywords.Words(spark, ["zz", "", "b"])
    assert [tuple(r) for r in df.select(words.first(F.col("t")), words.all(F.col("t"))).collect()] == [(1, [2]), (1, []), (None, [])]
    none = keywords.Words(spark, [])
    assert [tuple(r) for r in df.select(none.first(F.col("t")), none.all(F.col("t"))).collect()] == [(None, [])] * 3
