import itertools
import random

import pytest

from termloom.llm import canonical
from termloom.llm.set_join import PrefixIndex, similar_sets

REF = [("machine learning", "ml"), ("ml", "ml"), ("kubernetes", "kubernetes"), ("деловая переписка", "деловая переписка"), ("kotlin++", "kotlin++"), ("учёт накладных", "учёт накладных"), ("r2d", "r2d")]


def mapped(spark, values, ref=REF):
    v = spark.createDataFrame([("f", "1", x) for x in values], "field_name string, rec_id string, raw_value string")
    return {r.raw_value: r.canonical for r in canonical.map_values(v, spark.createDataFrame(ref, "alias string, canonical string")).collect()}


@pytest.mark.parametrize("threshold", [0.4, 0.7, 1.0])
def test_set_join_is_exact(spark, threshold):
    rng = random.Random(7)
    make = lambda n: [(str(k), list({f"t{rng.randrange(14) ** 2 % 23}" for _ in range(rng.randint(0, 8))})) for k in range(n)]
    left, right = make(80), make(60)
    want = {(a, b) for (a, x), (b, y) in itertools.product(left, right) if x and y and len({*x} & {*y}) / len({*x, *y}) >= threshold - 1e-9}
    df = lambda rows: spark.createDataFrame(rows, "id string, tokens array<string>")
    assert {(r.left_id, r.right_id) for r in similar_sets(df(left), df(right), threshold).collect()} == want


@pytest.mark.parametrize("threshold", [0.4, 0.7, 1.0])
def test_prefix_index_is_exact(threshold):
    rng = random.Random(8)
    make = lambda n: [(str(k), {f"t{rng.randrange(14) ** 2 % 23}" for _ in range(rng.randint(0, 8))}) for k in range(n)]
    left, right = make(300), make(60)
    uses = {f"t{k}": rng.randrange(50) for k in range(12)}  # any order finds all
    index = PrefixIndex(right, uses, threshold)
    for _, x in left:
        x = {*x, "unknown"} if rng.random() < 0.2 else x
        want = {(b, round(len(x & y) / len(x | y), 9)) for b, y in right if x and y and len(x & y) / len(x | y) >= threshold - 1e-9}
        assert {(b, round(s, 9)) for b, s in index.like(x)} == want


def test_a_reference_of_any_size_gives_the_same(spark):
    ref = [*REF, ("abcdefgz", "one"), ("abcdefgd", "two"), ("administration", "administration")]
    values = ["machin learning", "кубернетес", "лгиуктуеуы", "делов. переписка", "abcdefgh", "adm.", "machine juggling", "what", "kotlin++ 2.1", "ML ", "!!!", "🙂", "."]
    v = spark.createDataFrame([("f", "1", x) for x in values], "field_name string, rec_id string, raw_value string")
    r = spark.createDataFrame(ref, "alias string, canonical string")
    made = canonical.map_values(v, r, in_memory=3)
    assert {tuple(x) for x in made.collect()} == {tuple(x) for x in canonical.map_values(v, r).collect()}
    assert "BroadcastHashJoin" not in made._jdf.queryExecution().toString()


def test_long_values(spark):
    words = "machine learning and data science for big data teams"
    long = "- " * 300 + "kubernetes" + " (basic)" * 300
    assert mapped(spark, [words.replace(" ", ""), long], [(words, "x"), ("kubernetes", "kubernetes")]) == {words.replace(" ", ""): "x", long: "kubernetes"}


def test_long_words_of_few_letters_keep_their_keys():
    for n in (56, 58, 60, 61, 62, 70):
        word = "ab" * (n // 2) + "a" * (n % 2)
        for other in (word[1:], word[2:], word + "c", "xy" + word, word[:9] + "z" + word[9:]):
            assert canonical.difference(other, word) is not None and canonical.keys(other, False) & canonical.keys(word, True)
    assert len(canonical.keys("z" * 100_000, False)) < 10 and len(canonical.keys("ab" * 50_000, True)) < 20


def test_ways_of_writing(spark):
    got = mapped(
        spark,
        ["Machine-Learning", "machin learning", "learning: machine", "good command of kubernetes", "Kubernetes (basic)", "кубернетес", "лгиуктуеуы", "«деловая переписка»",
         "delovaya perepiska", "ltkjdfz gthtgbcrf", "делов. переписка", "kotlin++ 2.1", "kub​ernеtes", "учет накладных"],
    )
    assert {v: got[v] for v in got} == {
        "Machine-Learning": "ml", "machin learning": "ml", "learning: machine": "ml", "good command of kubernetes": "kubernetes", "Kubernetes (basic)": "kubernetes", "кубернетес": "kubernetes",
        "лгиуктуеуы": "kubernetes", "«деловая переписка»": "деловая переписка", "delovaya perepiska": "деловая переписка", "ltkjdfz gthtgbcrf": "деловая переписка", "делов. переписка": "деловая переписка",
        "kotlin++ 2.1": "kotlin++", "kub​ernеtes": "kubernetes", "учет накладных": "учёт накладных",
    }


def test_accepted_spellings_that_share_few_letter_pairs(spark):
    ref = [(x, x) for x in ("administration", "python", "dataflow", "deployment", "kubernetes cluster", "учёт", "jobs")]
    want = {"adm.": "administration", "p y t h o n": "python", "adtafolw": "dataflow", "dxploymxnt": "deployment", "k u b e r n e t e s c l u s t e t": "kubernetes cluster", "у ч е т": "учёт", "j.o.b.z": None}
    assert mapped(spark, list(want), ref) == want


def test_keys_meet_wherever_the_pairs_may_not():
    rng = random.Random(4)
    entries = ["dataflow", "analysis", "deployment", "банковский учёт", "data mining", "web services", "абвгдежз", "работа щитом", "abababab", "school", "чтение схем"]
    seen = 0
    for _ in range(20_000):
        e = rng.choice(entries)
        x = list(e)
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(len(x) - 1)
            x[i : i + 2] = rng.choice([[x[i + 1], x[i]], ["q", x[i + 1]], [x[i + 1]], [x[i], " ", x[i + 1]], [x[i], "z", x[i + 1]], [". "]])
        r = "".join(x).strip()
        if not canonical.fold(r) or canonical.difference(r, e) is None:
            continue
        a, b = ([{*canonical.letter_pairs(f)} for f in canonical._forms(canonical.fold(t))] for t in (r, e))
        if max(len(p & q) / len(p | q) for p in a for q in b) < canonical.SIMILARITY:
            seen += 1
            assert {*canonical.keys(r, False)} & {*canonical.keys(e, True)}, (r, e)
    assert seen > 100


def test_resembling_skills_are_unmatched(spark):
    values = ["machine juggling", "r2e", "деловая игра", "учёт париков", "gardening"]
    assert mapped(spark, values) == dict.fromkeys(values)


def test_aliases_nulls_blanks_ties_and_empty(spark):
    assert mapped(spark, ["ML ", None, " ", "kubernetes"]) == {}
    assert mapped(spark, ["abcdefgh"], [("abcdefgz", "one"), ("abcdefgd", "two")]) == {"abcdefgh": None}  # equally near
    assert mapped(spark, ["abcdefgh"], [("abcdefgz", "one"), ("abcdefgd", "one")]) == {"abcdefgh": "one"}
    assert mapped(spark, [], REF) == {} and mapped(spark, ["x y"], [(None, "a"), ("b", None)]) == {"x y": None}
    long = "z" * 50_000
    assert mapped(spark, [long, "! " * 20_000 + "a"]) == {long: None, "! " * 20_000 + "a": None}


def test_records_of_matched_values(spark):
    v = spark.createDataFrame([("f", "1", "kubernetis", 1), ("f", "1", "kubernetis", 2), ("f", None, "kubernetis", 3), ("g", "2", "what", 4)], "field_name string, rec_id string, raw_value string, canonical int")
    m = canonical.map_values(v, spark.createDataFrame(REF, "alias string, canonical string"))
    assert {tuple(r) for r in canonical.mapped_values(v, m).collect()} == {("f", "1", "kubernetis", "kubernetes")}


def test_distance():
    def full(a, b):
        d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    rng = random.Random(2)
    for _ in range(3000):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 7))) for _ in "12")
        assert canonical.distance(a, b, 3) == min(full(a, b), 4), (a, b)
