"""Golden rows for the scalar readers and text helpers (FIXTURES.md section 2)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import one_col
from quire.functions import lenient as L
from quire.functions import text as T


def _json(fn):
    """Apply a reader to JSON text parsed as a bare value."""
    return lambda c: fn(F.try_parse_json(c))


def test_lenient_string_and_text(spark):
    vals = ['"  Ab "', '"   "', '""', "null", "true", "[1]", "123", '" x　"',
            '{"type":"/type/text","value":" hi "}', '{"value":{"value":"x"}}', '{"value":7}',
            "1.0", "112946.26", "100.0", "1e300"]
    j2 = one_col(spark, vals, _json(L.lenient_string))
    j3 = one_col(spark, vals, _json(L.text_or_value))
    assert j2 == ["Ab", None, None, None, None, None, "123", "x", None, None, None,
                  "1.0", "112946.26", "100.0", "1e300"]
    assert j3[:11] == ["Ab", None, None, None, None, None, "123", "x", "hi", None, "7"]


def test_lenient_string_absent_field(spark):
    out = one_col(spark, ['{"a":1}'], lambda c: L.lenient_string(L.field(L.parse_record(c), "title")))
    assert out == [None]


def test_lenient_int(spark):
    vals = ["12", '"12"', '" 12 "', '"+5"', '"007"', "-3", "0", "12.0", '"12.0"', '"12 p."',
            "3000000000", '"3000000000"', "true", '""', "[12]"]
    assert one_col(spark, vals, _json(L.lenient_int)) == [
        12, 12, 12, 5, 7, -3, 0, None, None, None, None, None, None, None, None]


def test_arrays(spark):
    out = one_col(spark, ['["a"," b ","",null,3,{"x":1}]', '"a"'], _json(L.string_array))
    assert out == [["a", "b", "3"], []]
    out = one_col(spark, ["[-1,5,\"7\",null,3.0,99999999999,0,8]"], _json(L.int_array))
    assert out == [[5, 8]]
    out = one_col(spark, ['[{"key":"/works/OL1W"},"/works/OL2W",{"key":{"key":"/works/OL3W"}},5,{"key":7},{}]',
                          '{"key":"/works/OL1W"}'], _json(L.key_ref_array))
    assert out == [["OL1W", "OL2W", "OL3W"], []]
    assert one_col(spark, ['["", "/a/", {"key": ""}]'], _json(L.key_ref_array)) == [["", "", ""]]


def test_author_role_keys(spark):
    v = ('[{"author":{"key":"/authors/OL1A"}}, 5, {"author":"/authors/OL2A"}, {"key":"/authors/OL3A"},'
         ' "/authors/OL4A", {"author":7,"key":"/authors/OL5A"}]')
    assert one_col(spark, [v], _json(L.author_role_keys)) == [["OL1A", "OL2A", "OL3A", "OL4A", "OL5A"]]


def test_identifiers(spark):
    vals = ['{"amazon":["", "B01"],"goodreads":42,"google":{}}', "[]", '"x"']
    out = one_col(spark, vals, _json(L.identifiers))
    assert [tuple(r) for r in out] == [("B01", "42", None), (None, None, None), (None, None, None)]


def test_parse_record_strict(spark):
    vals = ['{"x":1}', '{"x":1}  ', '{"x":1} trailing', '{"x":1},{"y":2}', '{"x":1}]', '{"x":1}]}',
            "5", "[1]", "", '{"a":1,"a":2}', "{'a':1}", '{"x":1},"~end-of-record~"']
    ok = one_col(spark, vals, lambda c: L.parse_record(c).isNotNull())
    assert ok == [True, True, False, False, False, False, False, False, False, False, False, False]


def test_short_key(spark):
    assert one_col(spark, ["/works/OL1W", "OL1W", "/a/b/", ""], L.short_key) == ["OL1W", "OL1W", "", ""]


def test_extract_year(spark):
    vals = ["March 2005", "1995-03-01", "c1999.", "9999 2001", "19??", "20050301", "0999", "2100", "2101",
            "١٩٩٥"]
    assert one_col(spark, vals, T.extract_year) == [2005, 1995, 1999, 2001, None, None, None, 2100, None, None]


def test_slugify(spark):
    vals = ["Hello,  World!!", "--a--", "Les Misérables", "Les Misérables", "Фёдор Достоевский",
            "a" * 120, "a" * 99 + " b", "!!!", "Straße Œuvre Ærø"]
    assert one_col(spark, vals, T.slugify) == [
        "hello-world", "a", "les-miserables", "les-miserables", "fiodor-dostoevskii",
        "a" * 100, "a" * 99, "", "strasse-oeuvre-aero"]


def test_base_slugs(spark):
    df = spark.createDataFrame(
        [("9780000000002", "0000000000", "A B", "OL1M"), (None, "0000000000", None, "OL2M"),
         (None, None, "A B", "OL3M"), (None, None, None, "OL9M"), (None, None, "!!!", "OL9A")],
        "i13 string, i10 string, title string, k string")
    out = [r[0] for r in df.select(T.edition_base_slug("i13", "i10", "title", "k")).collect()]
    assert out == ["9780000000002-a-b", "0000000000", "a-b", "ol9m", "ol9a"]


def test_slug_suffix_roundtrip(spark):
    df = spark.createDataFrame([("john-smith",), ("john-smith--4",), ("john-smith-jr",)], "s string")
    base, n = T.split_slug("s")
    rows = df.select(base.alias("b"), n.alias("n"), T.compose_slug(base, n + 1).alias("next")).collect()
    assert [tuple(r) for r in rows] == [("john-smith", 1, "john-smith--2"), ("john-smith", 4, "john-smith--5"),
                                        ("john-smith-jr", 1, "john-smith-jr--2")]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(max_size=150), min_size=30, max_size=30))
def test_slugify_properties(spark, texts):
    out = one_col(spark, texts, T.slugify)
    again = one_col(spark, out, T.slugify)
    for s, s2 in zip(out, again):
        assert re.fullmatch(r"([a-z0-9]+(-[a-z0-9]+)*)?", s)
        assert len(s) <= 100
        assert s2 == s


_json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-2**40, 2**40) | st.floats(allow_nan=False, allow_infinity=False)
    | st.text(max_size=12),
    lambda kids: st.lists(kids, max_size=4) | st.dictionaries(st.sampled_from(["key", "author", "value", "x"]), kids,
                                                             max_size=3),
    max_leaves=12)


@settings(max_examples=1, deadline=None, suppress_health_check=[HealthCheck.data_too_large, HealthCheck.too_slow])
@given(st.lists(st.fixed_dictionaries({}, optional={
    f: _json_values for f in ["title", "works", "languages", "identifiers", "covers", "isbn_13", "number_of_pages",
                              "publish_date", "authors", "bio", "photos", "name"]}), min_size=40, max_size=40),
       st.lists(st.text(max_size=30), min_size=10, max_size=10))
def test_readers_never_raise(spark, records, junk):
    """Any JSON value in any known field, and junk lines, classify without errors."""
    import json

    from quire.operators import stage as S
    from quire.sources.dumps import split_rows

    lines = [f"/type/x\t/x/OL{i}X\t1\t2024\t{json.dumps(r)}" for i, r in enumerate(records)] + junk
    df = spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "line_no long, line string")
    parsed = S.parse_lines(split_rows(df))
    for classify in (S.classify_editions, S.classify_works, S.classify_authors):
        assert len(classify(parsed).collect()) == len(lines)


def test_first_accepted_skips_junk_at_the_front(spark):
    vals = ['["", " b ", 3]', '[null, {"x":1}]', '"a"', '[" a "]']
    assert one_col(spark, vals, _json(L.first_string)) == ["b", None, None, "a"]
    refs = ['[5, {"key":"/works/OL1W"}]', '[{"key":"/works/OL2W"}, "/works/OL3W"]', '{"key":"/works/OL1W"}']
    assert one_col(spark, refs, _json(L.first_ref_key)) == ["OL1W", "OL2W", None]
    ints = ["[-1, 0, 7]", "[3.0, 5]", "[]", "7"]
    assert one_col(spark, ints, _json(L.first_positive_int)) == [7, 5, None, None]


def test_float_text_matches_shortest_round_trip(spark):
    vals = ["1e7", "1.5e16", "1e-7", "2.5e-3", "0.000001", "0.00001", "123456789012345678901234567890.5",
            "12345678901234567.0", "1e16", "1234567.0", "0.1", "1e300", "-1.5e-7", "99999999999999999999",
            "18446744073709551615", "1e2", "1.0", "112946.26", "0.0", "-3", "9223372036854775808"]
    assert one_col(spark, vals, _json(L.lenient_string)) == [
        "10000000.0", "1.5e16", "1e-7", "0.0025", "1e-6", "0.00001", "1.2345678901234568e29",
        "1.2345678901234568e16", "1e16", "1234567.0", "0.1", "1e300", "-1.5e-7", "1e20",
        "18446744073709551615", "100.0", "1.0", "112946.26", "0.0", "-3", "9223372036854775808"]


def test_reference_keys_of_any_depth(spark):
    refs = []
    for depth in (1, 4, 5, 6, 60):
        v = '"/works/OL5W"'
        for _ in range(depth):
            v = f'{{"key": {v}}}'
        refs.append(v)
    refs += ['{"key": {"key": {"key": {"key": {"key": 7}}}}}', '{"key": {"key": {"key": {"key": {"other": "x"}}}}}']
    got = one_col(spark, [f"[{r}]" for r in refs], _json(L.key_ref_array))
    assert got == [["OL5W"]] * 5 + [[]] * 2
    assert one_col(spark, [f"[{r}]" for r in refs], _json(L.first_ref_key)) == ["OL5W"] * 5 + [None] * 2


#: Spellings by script, worked out by hand from the rules of ``functions/scripts.py``.
SCRIPT_NAMES = {
    "한국어": "hangugeo", "서울 값": "seoul-gabs", "김치찌개": "gimcijjigae",                       # Hangul
    "きょうと": "kyouto", "がっこう": "gakkou", "まっちゃ": "matcha", "じゅんび": "junbi",           # hiragana
    "トーキョー": "tokyo", "ファイル": "fairu", "ウィキペディア": "wikipedia", "チェック": "chekku", "シャツ": "shatsu",  # katakana
    "हिन्दी": "hindii", "भारत": "bhaarata", "संस्कृत १२": "samskrita-12", "आग": "aaga",         # Devanagari
    "বাংলা": "baamlaa", "ગુજરાતી": "gujaraatii", "தமிழ்": "tamizh", "తెలుగు": "telugu", "ಕನ್ನಡ": "kannada",  # other Indic scripts
    "Հայաստան": "hayastan", "և": "ev",                                                                # Armenian
    "საქართველო": "sakartvelo",                                                                          # Georgian
    "שלום": "shlvm", "ירושלים 5": "yrvshlym-5",                                                          # Hebrew
    "سلام": "slam", "كِتَاب": "kitaab", "مدرسة": "mdrsa",                                                    # Arabic
    "Кот 한 か x": "kot-han-ka-x", "日本": "", "っ": "", "ー": "", "्": "",                                 # mixed, unknown, marks alone
}


def test_slugify_reads_scripts_by_longest_match(spark):
    got = one_col(spark, list(SCRIPT_NAMES), T.slugify)
    assert dict(zip(SCRIPT_NAMES, got)) == SCRIPT_NAMES


def test_every_letter_of_the_scripts_is_spelled_in_ascii(spark):
    from quire.functions import scripts as S

    letters = [chr(c) for c in [*range(0x3041, 0x3097), *range(0x30A1, 0x30F7), *range(0xAC00, 0xD7A4, 7)]]
    letters += [chr(b + c) for b in range(0x0900, 0x0D80, 0x80) for c in range(0x80)]
    letters += [chr(first + k) for first, sounds in S.ALPHABETS.items() for k in range(len(sounds))]
    got = one_col(spark, letters, S.romanise)
    assert all(g.isascii() for g in got)
    plain = ["plain text", "", "naïve", "Привет", "日本 12"]
    assert one_col(spark, plain, S.romanise) == plain


def test_letters_that_stand_alone_are_looked_up_not_spelled_one_by_one(spark):
    from quire.functions import scripts

    text = "가나 かな कि ქა éx ж 漢"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(T.slugify("t")).first()[0] == "gana-kana-ki-ka-ex-zh"
    plan = df.select(scripts.romanise(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan and "/ 588" not in plan, "no syllable is taken apart while rows are read"
    assert "あ" not in scripts.TOKEN, "kana are a range, not letter by letter"


def test_year_is_read_without_a_lambda(spark):
    values = ["1999", "19999", "x2101y2100z", "0999 1000", "12 345", None, "", "May 2024, 1990", "a1850b1851", "٢٠٢٤ 2023"]
    assert one_col(spark, values, T.extract_year) == [1999, None, 2100, 1000, None, None, None, 2024, 1850, 2023]
    df = spark.createDataFrame([("1999",)], "v string").select(T.extract_year("v"))
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
