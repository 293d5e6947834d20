import os

import pytest

from termloom.llm import bpe, mixing

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.default_vocabulary()), reason="no vocabulary here")
DOCS = "doc_id long, source string, text string"
TARGETS = "source string, target_share double, max_repeats int"


def run(spark, docs, targets, **kw):
    d = spark.createDataFrame(docs, DOCS)
    plan = mixing.plan_mix(d, spark.createDataFrame(targets, TARGETS), **kw).cache()
    return {r.source: r for r in plan.collect()}, [tuple(r) for r in mixing.mix(d, plan).select("doc_id", "source", "copy").collect()]


def corpus():
    return [(k, "big" if k % 10 else "small", " ".join(["word"] * (1 + k % 7))) for k in range(400)]


def sizes(docs):
    enc = bpe.encoder(open(bpe.default_vocabulary(), "rb").read())
    return {i: len(enc.encode(t)) for i, _, t in docs}


def test_shares_budgets_and_copies(spark):
    docs = corpus()
    plan, mixed = run(spark, docs, [("big", 0.6, 1), ("small", 0.4, 3), ("none", 0.5, 2)])
    n = sizes(docs)
    for s in ("big", "small"):
        taken = [x for x in mixed if x[1] == s]
        assert sum(n[i] for i, _, _ in taken) == plan[s].taken_tokens <= plan[s].budget
        assert plan[s].budget - plan[s].taken_tokens < max(n.values())  # the next record would not have fitted
        assert max(c for *_, c in taken) <= {"big": 1, "small": 3}[s]
        assert len(taken) == plan[s].taken_docs
    assert abs(plan["small"].actual_share - 0.4) < 0.01 and plan["small"].reached
    assert plan["small"].epochs == 3  # the smallest against its share sets the size
    assert (plan["none"].taken_tokens, plan["none"].reached) == (0, False)
    assert len(set(mixed)) == len(mixed)


def test_given_total_and_capped_source(spark):
    plan, _ = run(spark, corpus(), [("big", 0.5, 1), ("small", 0.5, 2)], total_tokens=2000)
    assert plan["small"].taken_tokens == 2 * plan["small"].n_tokens < 1000 and not plan["small"].reached
    assert 990 <= plan["big"].taken_tokens <= 1000


def test_order_is_random_but_fixed(spark):
    targets = [("big", 0.7, 1), ("small", 0.3, 1)]
    one, two = (sorted(run(spark, corpus(), targets)[1]) for _ in "12")
    assert one == two
    assert sorted(run(spark, corpus(), targets, total_tokens=300)[1]) != one


def test_nulls_empties_repeats_and_clashes(spark):
    docs = [(1, "a", "x y"), (1, "a", "x y"), (None, "a", "x"), (2, "a", None), (3, "a", ""), (4, None, "x"), (5, "b", "long " * 20_000), (6, "a", "z")]
    plan, mixed = run(spark, docs, [("a", 0.5, 2), ("b", 0.5, 1), (None, 0.3, 1), ("c", None, None)])
    assert {i for i, *_ in mixed} <= {1, 5, 6}
    assert run(spark, [], [("a", 1.0, 1)])[1] == [] and run(spark, docs, [])[1] == []
    d = spark.createDataFrame([(1, "a", "x", 7, 8)], DOCS + ", epochs int, copy int")
    out = mixing.mix(d, mixing.plan_mix(d, spark.createDataFrame([("a", 1.0, 2)], TARGETS)))
    assert sorted((r.doc_id, r.epochs, r["copy"]) for r in out.collect()) == [(1, 7, 1), (1, 7, 2)]
