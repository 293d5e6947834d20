from collections import Counter
from itertools import combinations

import numpy as np

from termloom.llm import cooccur


def brute(baskets, least=1, share=0.0, lift=0.0):
    sets = {}
    for r, i in baskets:
        if r is not None and i is not None:
            sets.setdefault(r, set()).add(i)
    n, one, two = len(sets), Counter(), Counter()
    for s in sets.values():
        one.update(s)
        two.update(combinations(sorted(s), 2))
    return {(a, b, k, one[a], one[b], n) for (a, b), k in two.items() if k >= least and k >= share * n and k * n >= lift * one[a] * one[b]}


def run(spark, baskets, **kw):
    out = cooccur.cooccurring_pairs(spark.createDataFrame(baskets, "r string, i string"), "r", "i", **kw)
    return {(x.item_a, x.item_b, x.n_ab, x.n_a, x.n_b, x.n) for x in out.collect()}


def test_like_brute_force(spark):
    rng = np.random.default_rng(1)
    baskets = [(str(r), f"i{rng.integers(40) ** 2 % 31}") for r in range(200) for _ in range(rng.integers(0, 9))]
    assert run(spark, baskets, min_count=1) == brute(baskets)
    assert run(spark, baskets, min_count=2, min_share=0.02, min_lift=2) == brute(baskets, 2, 0.02, 2)
    assert run(spark, baskets, min_count=1, min_lift=1.3) == brute(baskets, 1, 0, 1.3)


def test_long_baskets_are_multiplied_in_blocks(spark):
    baskets = [(r, f"i{k:04d}") for r in ("a", "b") for k in range(600)] + [("c", "i0001"), ("c", "i0599")]
    assert run(spark, baskets, min_count=2) == brute(baskets, 2)


def test_nulls_repeats_singles_and_empty(spark):
    baskets = [("1", "a"), ("1", "a"), ("1", "b"), ("2", "a"), (None, "b"), ("3", None)]
    assert run(spark, baskets, min_count=1) == {("a", "b", 1, 2, 1, 2)}
    assert run(spark, [], min_count=1) == set()


def test_large_dictionary_is_joined_by_shuffling(spark, monkeypatch):
    baskets = [(str(r), f"i{(r * k) % 17}") for r in range(60) for k in range(1, 5)]
    monkeypatch.setattr(cooccur, "BROADCAST_ITEMS", 3)
    assert run(spark, baskets, min_count=1) == brute(baskets)


def test_extra_columns(spark):
    df = spark.createDataFrame([("1", "a", 5, 6), ("1", "b", 5, 6)], "r string, i string, rec int, item int")
    assert cooccur.cooccurring_pairs(df, "r", "i", min_count=1).count() == 1
