import pytest

from termloom.llm import confusables

SCHEMA = "field_name string, rec_id string, raw_value string"


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("ＳＱＬ　dev", "SQL dev"),
        ("Tea​m﻿ spi­rit", "Team spirit"),
        ("zéro й", "zéro й"),
        ("\U0001d420\U0001d42e\U0001d425", "gul"),
        ("a‑b−c", "a-b-c"),
        ("Lеdgеr", "Ledger"),
        ("приeм", "прием"),
        ("SΗIFT Κod", "SHIFT Kod"),
        ("\U0001f525 Hot job", "\U0001f525 Hot job"),
        ("\U0001f469‍\U0001f4bb d‍e‍v", "\U0001f469‍\U0001f4bb dev"),
        ("Javaскрипт", "Javaскрипт"),  # no look-alike for every letter
        ("«ёж» №5 — ½", "«ёж» №5 — ½"),
        ("  plain\t text \r\n", "plain text"),
        ("", ""),
    ],
)
def test_plain(raw, clean):
    assert confusables.plain(raw) == clean
    assert confusables.plain(clean) == clean


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("L\u0435dg\u0585r", "Ledgor"),  # Cyrillic, Armenian
        ("\ua4e2erver", "Server"),  # Lisu
        ("\u13daerver \u13e2ython", "Server Python"),  # Cherokee
        ("пр\u0585ект", "проект"),  # Armenian in Cyrillic
        ("\u0570\u0561\u0575o\u0581", "\u0570\u0561\u0575\u0585\u0581"),  # Latin in Armenian
        ("lo\u0261in d\u0251ta", "login data"),  # Latin in Latin
        ("\u0570\u0561\u0575\u0565\u0580\u0565\u0576 \u10e5\u10d0\u10e0", "\u0570\u0561\u0575\u0565\u0580\u0565\u0576 \u10e5\u10d0\u10e0"),
    ],
)
def test_more_scripts(raw, clean):
    assert confusables.plain(raw) == clean
    assert confusables.plain(clean) == clean


def test_dotless_i_is_decided_by_the_vocabulary(spark):
    rows = [("f", "1", "l\u0131st"), ("f", "2", "list of lists"), ("f", "3", "list"), ("f", "4", "k\u0131rm\u0131z\u0131")]
    assert cleaned(spark, rows) == {("1", "l\u0131st"): "list"}


def cleaned(spark, rows):
    return {(r.rec_id, r.raw_value): r.clean_value for r in confusables.clean_values(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_only_changed_characters_are_a_case(spark):
    rows = [("f", "1", " a  b\n"), ("f", "2", "a b"), ("f", "3", "é"), ("f", "4", None), ("f", None, "a b"), ("f", "5", ""), ("f", "6", "​"), ("f", "2", "a b")]
    assert cleaned(spark, rows) == {("2", "a b"): "a b", ("6", "​"): ""}


def test_ties_are_decided_by_the_vocabulary(spark):
    # two letters of each script: "ко" as Cyrillic, "pa" as Latin
    tie = "саpe"
    assert len(confusables.readings(tie)) == 2
    assert cleaned(spark, [("f", "1", tie), ("f", "2", "cape town")])["1", tie] == "cape"
    assert cleaned(spark, [("f", "1", tie), ("f", "2", "саре"), ("f", "3", "саре"), ("f", "4", "cape")])["1", tie] == "саре"


def test_empty_long_and_extra_columns(spark):
    assert cleaned(spark, []) == {}
    long = "а" * 100_000 + "​"
    assert len(cleaned(spark, [("f", "1", long)])["1", long]) == 100_000
    df = spark.createDataFrame([("f", "1", "a b", "x", 1)], SCHEMA + ", clean_value string, word int")
    assert [r.clean_value for r in confusables.clean_values(df).collect()] == ["a b"]


def test_words_of_the_corpus_may_have_to_confirm(spark):
    values = [("f", "1", "раsport"), ("f", "2", "паспорт"), ("f", "3", "пacпорт"), ("f", "4", "зaгрyз"), ("f", "5", "ｆｕｌｌ"), ("f", "6", "sport")]
    df = spark.createDataFrame(values, "field_name string, rec_id string, raw_value string")
    got = lambda how: {r.raw_value: r.clean_value for r in confusables.clean_values(df, how).collect()}
    assert got("ties") == {"раsport": "pasport", "пacпорт": "паспорт", "зaгрyз": "загруз", "ｆｕｌｌ": "full"}
    assert got("always") == {"пacпорт": "паспорт", "ｆｕｌｌ": "full"}  # no other result is a word of the corpus
    with pytest.raises(ValueError):
        confusables.clean_values(df, "never")
