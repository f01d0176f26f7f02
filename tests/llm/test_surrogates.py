"""Surrogates in very long mentions, of phones in every form, and with a configured key."""

import re

from quire.llm import pii

N = 100_000


def replaced(spark, texts, key="k", **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.replace(df, key=key, **more).orderBy("doc_id").collect()]


def test_mentions_of_any_length_are_replaced_whole(spark):
    texts = ["so " + "Mr " * N + "Berg came", "to joe@a" + ".b" * N + ".com now", "Mr " + "ب" * N + " came", "Mr " * N + "came",
             "Mr " + "क" * N + " came", "joe@" + "a." * N, "Dr. " * N + "Anna Berg, Berg", "x" * N, "z" * N + "@", "Z" * N + " Mr B" + "c" * N]
    got = replaced(spark, texts)
    titles = "Mr " * N
    assert re.fullmatch(r"so " + r"\w+ came", got[0].replace(titles, "", 1)) and "Berg" not in got[0]
    assert re.fullmatch(r"to \w+@[\w.-]+\.example now", got[1]) and "joe" not in got[1] and ".b.b" not in got[1][:40] + got[1][-40:]
    assert "بب" not in got[2] and got[2].startswith("Mr ") and got[2].endswith(" came")
    assert got[3] == texts[3] and got[5] == texts[5] and got[7] == texts[7] and got[8] == texts[8]
    assert "कक" not in got[4]
    name = re.fullmatch(r"(\w+) (\w+), (\w+)", got[6].replace("Dr. " * N, "", 1)).groups()
    assert name[1] == name[2] and not {"Anna", "Berg"} & set(name)
    assert got[9].startswith("Z" * N + " Mr ") and "c" * 50 not in got[9]


def test_one_phone_in_national_and_international_form(spark):
    forms = ["(017) 555-7713", "+1 (017) 555-7713", "+1 017 555-7713", "001 017 555 7713", "(017) 555 7713"]
    got = [re.sub("[^0-9]", "", t) for t in replaced(spark, [f"call {f} now" for f in forms])]
    assert len({t[-9:] for t in got}) == 1 and got[0][-9:] != "175557713"
    german = [re.sub("[^0-9]", "", t) for t in replaced(spark, ["+49 30 1234567", "030 1234567", "0049 30 1234567"])]
    assert len({t[-9:] for t in german}) == 1 and german[0].startswith("49") and german[2].startswith("0049")
    shape = [re.sub("[0-9]", "9", t) for t in replaced(spark, forms)]
    assert shape == [re.sub("[0-9]", "9", f) for f in forms]


def test_plain_numbers_are_no_phones(spark):
    texts = ["12 345 678 units", "1920 1080 2160", "12.345.678 EUR", "between 1999 2004 2010", "1 234 567 890", "10 000 000"]
    assert replaced(spark, texts) == texts
    phones = ["call 555 123 4567 now", "call 555-123-4567 now", "call 555.123.4567 now"]
    assert not [t for t in replaced(spark, phones) if t in phones]


def test_the_key_comes_from_the_settings_and_is_never_a_known_one(spark):
    text = ["Mrs Anna Berg, ann@mail.org"]
    spark.conf.set(pii.KEY_SETTING, "one")
    try:
        one = replaced(spark, text, key=None)
        assert one == replaced(spark, text, key="one") != replaced(spark, text, key="two")
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    drawn = pii.secret_key(spark)
    assert len(drawn) == 64 and drawn == pii.secret_key(spark)


def test_columns_of_any_name_are_kept(spark):
    names = ["__d", "__key", "__any", "__found", "__gaps", "__new", "__names", "___d"]
    df = spark.createDataFrame([(1, "Mrs Anna Berg", *names)], ["doc_id", "text", *names])
    got = pii.replace(df, key="k", count="n")
    assert got.columns == [*df.columns, "n"] and [got.first()[c] for c in names] == names and got.first().n == 1
