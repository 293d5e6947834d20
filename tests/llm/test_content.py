import math
import os
import random
import re
import time

import pytest

from termloom.llm import content

DATA = "/root/testdata/sf0.01/content_examples.parquet"


def labelled():
    import pyarrow.parquet as pq

    return [(r["text"], r["label"] != "none") for r in pq.read_table(DATA).to_pylist()]


needs_data = pytest.mark.skipif(not os.path.exists(DATA), reason="no labelled texts here")


@pytest.fixture(scope="module")
def model():
    if not os.path.exists(DATA):
        pytest.skip("no labelled texts here")
    return content.fit(labelled())


@pytest.mark.parametrize("text", ["Get lost, you m0r0n!", "what an i-d-i-o-t you are", "you are a s c u m b a g", "ты му*ак", "Ты к0зёл", "you iiidioooot", "you are an idi​ot", "Fine text. Hello.\nYou absolute scumbag"])
def test_disguises_are_seen(model, text):
    assert model.score(text) >= content.THRESHOLD


@pytest.mark.parametrize("text", ["I <3 this place.\nYou idiot.\n-> next", "you <idiot>", "pay < 5, <a real idiot> like you > all", "<p class='x' hidden>Fine.</p><br/>you <b>idiot</b>"])
def test_only_tags_are_mark_up(model, text):
    assert model.score(text) >= content.THRESHOLD


LONG = ("the", "shop", "opens", "at", "nine", "and", "sells", "bread", "and", "butter") * 5


@pytest.mark.parametrize("insult", ["1d10t", "idi*t", "idoit", "idiooot", "i-d-i-o-t", "i.d-i.o-t", "f**k", "a$$hole", "idi" + "*" * 150 + "t"])
@pytest.mark.parametrize("joint", [",", "_", "...", "/", "-", "+"])
def test_disguises_in_long_runs_are_seen(model, insult, joint):
    assert model.score(joint.join([*LONG, "you", insult, *LONG])) >= content.THRESHOLD  # said to someone, not only a word of a list
    assert model.score(joint.join([*LONG, "you", "clerk", *LONG])) < content.THRESHOLD


def test_long_runs_take_linear_time(model):
    assert model.score("idi" + "o" * 100_000 + "t") >= content.THRESHOLD and model.score("id" + "*" * 100_000 + "ot!") >= content.THRESHOLD
    began = time.time()
    for x in ("w", "a-", "a_b1", "-", "a,", "1", ".a", "ж*"):
        model.score("a" + x * 100_000 + "a")
    assert time.time() - began < 60


def test_tags_part_sentences():
    parts = ["a", "b", "c", "d", "e", "f"]
    assert content.sentences("a<br>b<A HREF='x y' target=_blank>c</a ><!-- idiot -->d<o:p/>e<img\nsrc=\"i.png\" alt=\"idiot\" />f") == parts
    assert content.sentences("a <3 b") == ["a <3 b"] and content.sentences("x<i" + " a=b" * 50_000) == ["x<i" + " a=b" * 50_000]


@pytest.mark.parametrize("text", ["The farm has a donkey and a pig.", "We strip the labels and screw the lids on.", "Козёл для распилки лежит в мастерской.", "Southerners and women work side by side here.", "", "   ", None])
def test_neutral_talk_is_none(model, text):
    assert model.score(text) < content.THRESHOLD


def test_common_words_are_no_misspellings(spark):
    docs = spark.createDataFrame([(f"batch number {k}",) for k in range(50)], "text string")
    common, no_typos = content.corpus_words(docs)
    assert {"batch", "number"} <= common and no_typos == {"batch"}
    assert content.Words(no_typos).of("batch") == ("batch",) and content.Words().of("batch") == ("bitch",)


def test_copies_make_no_word_common(spark):
    docs = spark.createDataFrame([(f"batch number {k}",) for k in range(60)] + [(f"You are a total  idoit{'!' * (k % 3)}",) for k in range(30)], "text string")
    common, no_typos = content.corpus_words(docs)
    assert no_typos == {"batch"} and common == {"batch", "number"}
    assert content.Words(no_typos).of("idoit") == ("idiot",)


def test_group_names_do_not_move_the_score(model):
    scores = [model.score(f"We welcome {g} in our office.") for g in ("migrants", "women", "southerners", "muslims")]
    assert max(scores) - min(scores) < 0.05


@needs_data
def test_held_out_accuracy():
    rows = labelled()
    random.Random(1).shuffle(rows)
    wrong = 0
    for k in range(4):
        m = content.fit([x for i, x in enumerate(rows) if i % 4 != k])
        wrong += sum((m.score(t) >= content.THRESHOLD) != y for i, (t, y) in enumerate(rows) if i % 4 == k)
    assert wrong <= 0.03 * len(rows)


def templates(model, rows):
    """The offending texts by the form of their worst sentence: those whose words are alike by two fifths."""
    found = []
    for t, y in rows:
        if y:
            worst = max((model.score(s), s) for s in content.sentences(t))[1]
            words = {*re.findall(r"\w+", worst.lower())}
            for own in found:
                if any(len(words & x) >= 0.4 * len(words | x) for _, x in own):
                    own.append((t, words))
                    break
            else:
                found.append([(t, words)])
    return found


@needs_data
def test_forms_that_were_held_out_are_found(model):
    rows = labelled()
    forms, clean = templates(model, rows), [t for t, y in rows if not y]
    random.Random(3).shuffle(forms)
    random.Random(4).shuffle(clean)
    found = total = false = 0
    for k in range(6):
        held, others = {t for own in forms[k::6] for t, _ in own}, {*clean[k::6]}
        m = content.fit([(t, y) for t, y in rows if t not in held | others])
        found += sum(m.score(t) >= content.THRESHOLD for t in held)
        total += len(held)
        false += sum(m.score(t) >= content.THRESHOLD for t in others)
    assert len(forms) > 25 and found >= 0.8 * total and false <= 0.02 * len(clean)


@needs_data
def test_the_weights_are_learned(model):
    texts = [t for t, y in labelled() if y]
    prior = content.Model(dict(content.PRIOR), -content.BIAS)
    assert sum(prior.score(t) >= content.THRESHOLD for t in texts) == 0 and max(content.PRIOR.values()) < content.BIAS
    assert sum(model.score(t) >= content.THRESHOLD for t in texts) == len(texts)


FRESH = "I'll slit your throat|All immigrants should be shot|Ты жалкий червь, сдохни|Muslims are animals and must be deported|Убью тебя, тварь|Цыгане все воры, гнать их отсюда|Заткни пасть, дегенерат|Раздевайся, крошка, хочу тебя трахнуть"
MENTIONED = "Our policy forbids calling anyone an idiot|A moron test from psychology history|Sex: female. Nude colours, king size bed range|The word bastard is marked as offensive in the dictionary|Правила запрещают называть коллегу идиотом|The scene should be shot at night|Dead workers are killed at month end"


@pytest.mark.parametrize("text", FRESH.split("|"))
def test_unseen_forms(model, text):
    assert model.score(text) >= content.THRESHOLD


@pytest.mark.parametrize("text", MENTIONED.split("|"))
def test_mention_is_no_use(model, text):
    assert model.score(text) < content.THRESHOLD


@needs_data
def test_the_penalty_evens_out_groups(model):
    rows = labelled()
    free = content.fit(rows, balance=0.0)
    names = ["migrants", "women", "veldans", "torrishmen", "muslims", "southerners"]

    def spread(m, text):
        z = [math.log(p / (1 - p)) for p in (m.score(text.format(x)) for x in names)]
        return max(z) - min(z)

    for text in ("We welcome {} in our office.", "The {} next door sell bread."):
        assert spread(model, text) < 0.7 * spread(free, text)
    assert {"veldans", "вельданцы"} <= model.groups  # learned from where they stand


def test_tables(spark):
    ex = spark.createDataFrame([(k, "you idiot", "abusive") for k in range(20)] + [(k, f"hello there {k}", "none") for k in range(20, 60)] + [(90, None, "none"), (91, "x", None)], "example_id int, text string, label string")
    docs = spark.createDataFrame([(1, "you idiot", "s", 1.0), (2, None, None, None), (3, "", "s", 2.0), (1, "hello " * 50_000, "s", 3.0), (4, "w" * 200_000, None, 4.0)], "doc_id long, text string, source string, score double")
    model = content.train(ex, docs)
    out = content.score_documents(docs, model)
    assert out.columns == ["doc_id", "source", "score", "offends"] and out.count() == 5
    assert [r.doc_id for r in out.where("offends").collect()] == [1]
    rates = {r.source: (r.n_docs, r.n_offending) for r in content.rates(out).collect()}
    assert rates == {"s": (3, 1), None: (2, 0)}
    assert content.score_documents(docs.limit(0), model).count() == 0
    assert content.train(ex.limit(0), docs.limit(0)).score("you idiot") < content.THRESHOLD  # nothing was learned
