import os
import random
import time

import numpy as np
import pytest

from termloom.llm import near_dup
from termloom.session import shared_folder

SCHEMA = "id string, body string, title string"


def pairs(spark, rows, **kw):
    return {tuple(r) for r in near_dup.near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA), "id", "body", "title", **kw).collect()}


def brute(rows, t, shingle, least):
    sets = []
    for i, body, title in rows:
        w = near_dup.words(body)
        if i is not None and len(w) >= least:
            w = near_dup.words(title) + w
            sets.append((i, {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)}))
    return {(a, b) for a, x in sets for b, y in sets if a < b and x and y and len(x & y) >= t * len(x | y)}


def corpus(n=60, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(n):
        base = rng.choices(vocabulary, k=60)
        rows.append((f"{k}a", " ".join(base), f"name {k}"))
        for copy in range(rng.choice((0, 0, 1, 3))):
            text = list(base)
            for _ in range(rng.randint(0, 14)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((f"{k}{'bcd'[copy]}", " ".join(text), f"name {k}"))
    return rows


@pytest.mark.parametrize("threshold, shingle", [(0.6, 1), (0.8, 5)])
def test_like_brute_force(spark, threshold, shingle):
    rows = corpus()
    assert pairs(spark, rows, threshold=threshold, shingle=shingle, min_words=20, recall=0.9999) == brute(rows, threshold, shingle, 20)


def test_hot_band_values_are_split(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK", 4)
    base = [f"w{k}" for k in range(50)]
    rows = [(f"{k:03d}", " ".join(base + [f"x{k}"]), None) for k in range(40)]  # a third and more of all rows alike
    got = pairs(spark, rows, threshold=0.8, shingle=1)
    assert got == brute(rows, 0.8, 1, 1) and len(got) == 40 * 39 // 2


def test_sketches_are_compared_by_all_bits(spark):
    rows = spark.createDataFrame([(k, 10, *[-1 if (k + c) % 2 else 2**62 for c in range(near_dup.LONGS)]) for k in range(4)], f"num long, n int, {', '.join(f'{c} long' for c in near_dup.SKETCH)}")
    hot = spark.createDataFrame([(7, k) for k in range(4)], "hot_band long, num_a long")
    assert {tuple(r) for r in near_dup._meet_hot(hot, rows, 0.6).collect()} == {(0, 2), (1, 3)}


def test_large_classes_are_split(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "MEMBERS", 3)
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(f"{k:02d}", text, None) for k in range(14)] + [(f"x{k}", text + " more", None) for k in range(5)]
    got = pairs(spark, rows, threshold=0.8, shingle=1)
    assert got == brute(rows, 0.8, 1, 1) and len(got) == 19 * 18 // 2


def test_band_values_that_fill_several_batches(spark):
    n = near_dup.CHUNK + 300
    rows = spark.range(n).selectExpr("1L AS band", "id AS num", "10 AS n").union(spark.range(3).selectExpr("id * 2 AS band", "id + 7 AS num", "5 AS n")).union(spark.range(2).selectExpr("2L AS band", "id AS num", "6 AS n"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        met = near_dup._meet(rows, 0.6).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.num_a for r in met if r.hot_band == 1) == [*range(n)]
    assert {(r.num_a, r.num_b) for r in met if r.hot_band is None} == {(0, 1), (0, 8), (1, 8)}


def test_candidates_are_compared_where_they_meet(spark):
    """What unlike classes share in a band is not written; their number grows as the square of the data."""
    rng = np.random.default_rng(1)
    sketches = rng.integers(-(2**63), 2**63, (300, near_dup.LONGS))
    sketches[7] = sketches[200]
    rows = spark.createDataFrame([(1, k, 10, *map(int, x)) for k, x in enumerate(sketches)], f"band long, num long, n int, {', '.join(f'{c} long' for c in near_dup.SKETCH)}")
    assert [(r.num_a, r.num_b) for r in near_dup._meet(rows, 0.6).collect()] == [(7, 200)]


def test_passes_have_all_bands_and_few_bytes():
    for bands, classes, features in ((145, 0, 0), (145, 58_000, 5_600_000), (145, 9_000_000, 900_000_000), (3, 10**9, 10**9)):
        passes = near_dup.plan_passes(bands, classes, features)
        assert [k for first, end in passes for k in range(first, end)] == [*range(bands)]
        most = max(near_dup.PASS_BYTES, 8 * features) + classes * near_dup.ENTRY
        assert all((end - first) * classes * near_dup.ENTRY <= most for first, end in passes)


def test_no_files_of_a_pass_outlive_the_next(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "plan_passes", lambda bands, *_: [(0, 1), (1, bands // 2), (bands // 2, bands)])
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in map(str, (x.getName() for x in spark._jvm.scala.jdk.CollectionConverters.SeqHasAsJava(disk.getAllFiles()).asJava())) if f.startswith("shuffle")}
    release, before, left = near_dup.release, shuffled(), []

    def released(spark):
        release(spark)
        until = time.time() + 2
        while (new := shuffled() - before) and time.time() < until:
            time.sleep(0.2)
            release(spark)
        left.append(new)

    monkeypatch.setattr(near_dup, "release", released)
    rows = corpus(30)
    out = near_dup.near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA), "id", "body", "title", threshold=0.6, shingle=1, recall=0.9999)
    assert len(left) == 5 and not any(x & y for x, y in zip(left, left[1:]))
    assert {tuple(r) for r in out.collect()} == brute(rows, 0.6, 1, 1)
    folder = shared_folder(spark)
    assert not [x for x in os.listdir(folder) if x.startswith("near_dup")]


def test_ids_with_several_texts_come_out_once(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [("1", text, None), ("1", text + " more", None), ("2", text, None), ("2", text + " less", None), ("3", text, None), ("4", text, None)]
    got = near_dup.near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA), "id", "body", "title", shingle=1).collect()
    assert sorted(map(tuple, got)) == [(a, b) for a in "1234" for b in "1234" if a < b]


def test_nothing_that_grows_is_broadcast(spark):
    df = spark.createDataFrame(corpus(20), SCHEMA)
    for make in (near_dup.near_duplicate_pairs, near_dup.near_duplicate_groups):
        out = make(df, "id", "body", "title", shingle=1, threshold=0.6)
        out.collect()
        assert "Broadcast" not in out._jdf.queryExecution().toString()


def test_copies_are_one_class(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(str(k), text, None) for k in range(5)] + [("x", text + " more", None), ("y", " ".join(f"z{k}" for k in range(30)), None)]
    out = near_dup.near_duplicate_groups(spark.createDataFrame(rows, SCHEMA), "id", "body", "title", shingle=1)
    got = {r.id: (r.class_size, r.n_links) for r in out.collect()}
    assert got == {**{str(k): (5, 1) for k in range(5)}, "x": (1, 1), "y": (1, 0)}


def test_nulls_short_long_and_repeated(spark):
    long = " ".join(f"w{k}" for k in range(40_000))
    rows = [(None, long, "n"), ("1", None, "n"), ("2", "", "n"), ("3", "too short", None), ("4", long, None), ("4", long, None), ("5", "<p>" + long + "</p>", None), ("6", "a" * 300_000, None)]
    assert pairs(spark, rows, shingle=1, min_words=3) == {("4", "5")}  # the rows of one id are no pair
    assert pairs(spark, []) == set()
    df = spark.createDataFrame([("1", "a b c", 1, 2), ("2", "a b c", 1, 2)], "id string, body string, class_id int, feats int")
    assert near_dup.near_duplicate_pairs(df, "id", "body", shingle=1).count() == 1


def test_words_and_mark_up():
    assert near_dup.words("İ one <!-- no --> two <SCRIPT>three</script> four") == ["i\u0307"[:1], "one", "two", "four"]
    assert near_dup.words("<p>A&amp;B<br>c</p><!-- no --><script>var x</script>Ёж_2") == ["a", "b", "c", "ёж", "2"]
    near_dup.words("<!--" * 50_000 + "<" * 50_000)  # linear


def test_plan_reaches_the_recall():
    for t in (0.5, 0.6, 0.8, 0.95, 1.0):
        b, r = near_dup.plan_bands(t, 0.999)
        assert 1 - (1 - t**r) ** b >= 0.999 and b * r <= near_dup.MAX_HASHES


def test_readme_names_the_bands():
    with open(os.path.join(os.path.dirname(__file__), "../../README.md"), encoding="utf-8") as f:
        assert f"each text sends {near_dup.plan_bands(0.6, 0.999)[0]} band values" in f.read()
