import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordmill.functions import entities, text
from wordmill.functions.constants import MONTHS, PLACEHOLDERS, STOPWORDS

KINDS = list(PLACEHOLDERS)


def cleaned(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    marked = df.select("i", entities.mark_entities(F.col("t")).alias("m"))
    out = marked.select(
        "i", text.join_tokens(text.tokens_of_marked(F.col("m"))).alias("c"),
        *[entities.entity_list(F.col("m"), k).alias(k) for k in KINDS],
    )
    return [r for r in sorted(out.collect())]


CASES = [
    ("On 2016-01-02 see https://x.com/2016-01-02/a;1", "on <DATE> see <URL>"),
    ("5 marines", "<DATE>"),
    ("3.14 1,234 covid-19", "<NUMBER> <NUMBER> <NUMBER> <NUMBER> covid <NUMBER>"),
    ("end.of", "<URL>"),
    ("don't", "don t"),
    ("café.com éabc.fr", "caf com abc fr"),
    ("", ""),
    (None, ""),
    ("<b>Bold</b> a<b", "<b>bold< b> a<b"),
    ("20th of may, jan 5, 2016 and the 20th", "<DATE> <DATE> and the th"),
    ("a.b@c.org,x", "<EMAIL> x"),
    ("5 may.x@y.com", "<DATE> <EMAIL>"),
    ("xhttp://foo.de/a b", "x <URL> b"),
    ("12\x0113 a\x02b", "<NUMBER> <NUMBER> a b"),
    ("www. wwww.x", "www w <URL>"),
    ("may-dec 5, 2016", "may <DATE>"),
]


def test_cleaning_cases(spark):
    rows = cleaned(spark, [c[0] for c in CASES])
    assert [r.c for r in rows] == [c[1] for c in CASES]
    assert rows[0].dates == ["2016-01-02"] and rows[0].urls == ["https://x.com/2016-01-02/a;1"]
    assert rows[10].emails == ["a.b@c.org"]
    assert rows[2].numbers == ["3", "14", "1", "234", "19"]


def test_worked_example(spark):
    t = (
        "On 2016-01-02 see https://x.com/2016-01-02/a;1 or mail a.b@c.org, 5 marines, 20th of may, "
        "jan 5, 2016 3.14 covid-19 1,234 end.of www.foo.com/x) don't"
    )
    want = (
        "on <DATE> see <URL> or mail <EMAIL> <DATE> <DATE> <DATE> <NUMBER> <NUMBER> covid <NUMBER> "
        "<NUMBER> <NUMBER> <URL> <URL> don t"
    )
    assert cleaned(spark, [t])[0].c == want


# The pattern of the entities.
def _plain_pattern():
    month = "(?:" + "|".join(MONTHS) + ")[a-z]*"
    url_char = r"""[^\s)\]}'<>"]"""
    return re.compile(
        rf"(\b\d{{4}}-\d{{2}}-\d{{2}}\b|\b\d{{2}}/\d{{2}}/\d{{4}}\b|\b\d{{2}}\.\d{{2}}\.\d{{4}}\b"
        rf"|\b{month}\s\d{{1,2}},?\s\d{{4}}\b|\b\d{{1,2}}\s{month}\b"
        rf"|\b\d{{1,2}}(?:st|nd|rd|th)?\s(?:of\s)?{month}\b)"
        r"|(\b[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}\b)"
        rf"|(https?://{url_char}+|www\.{url_char}+|\b[a-z0-9-]+\.[a-z]{{2,}}(?:/{url_char}*)*)"
        r"|(\b\d+\b)",
        re.IGNORECASE,
    )


PLAIN = _plain_pattern()


def expected(value):
    """Brute force: the plain pattern, one match after the other."""
    low = value.lower()
    found = {k: [] for k in KINDS}

    def swap(match):
        kind = KINDS[match.lastindex - 1]
        found[kind].append(match.group())
        return f" {PLACEHOLDERS[kind]} "

    out = PLAIN.sub(swap, low)
    return " ".join(re.sub(r"[^a-zA-Z <>]", " ", out).split()), found


PIECES = [
    "2016-01-02", "01/02/2016", "01.02.2016", "jan 5, 2016", "5 may", "20th of ", "marines", "dec",
    "a.b@c.org", "x_y%z@", "@", "http://", "https://x.y/z?q=1", "www.", "foo.com", "/path/", ".de",
    "12", "3.14", "é", "ſ", "ñandú", "-", "_", ".", " ", "  ", "\n", ")", "'", '"', "<b>", ";", ",",
    "word", "a", "st", "of", "+", "%", "٣", "1st", "B2", " ", "😀",
]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=80, max_size=80))
def test_single_pass_equals_plain_pattern(spark, values):
    for value, row in zip(values, cleaned(spark, values)):
        want, found = expected(value)
        assert row.c == want, value
        assert {k: row[k] for k in KINDS} == found, value


def test_long_runs_are_exact_and_fast(spark):
    values = [
        "a." * 20000, "a-" * 20000, "1." * 20000, "x" * 40000 + "1", "x" * 400 + "@host.org",
        "y" * 300 + ".com/z", "ab-" * 200 + "c.org", "q." * 300 + "q@mail.example.com tail",
    ]
    rows = cleaned(spark, values)
    for row, value in list(zip(rows, values))[4:]:
        want, found = expected(value)
        assert row.c == want
        assert {k: row[k] for k in KINDS} == found
    assert len(rows[2].numbers) == 20000


def test_stopwords(spark):
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 127
    df = spark.createDataFrame([(["the", "<DATE>", "cat", "<the>", "don"],)], "t array<string>")
    assert df.select(text.remove_stopwords(F.col("t"))).first()[0] == ["<DATE>", "cat", "<the>"]
    assert df.select(text.remove_stopwords(F.col("t"), ["<DATE>", "cat"])).first()[0] == [
        "the", "<DATE>", "<the>", "don",
    ]


@pytest.mark.parametrize("given_,want", [
    (["007", "12"], "7; 12"),
    (["a", "b"], "a;  b"),
    ([], ""),
    (["3"], "3"),
    (["http://x/a;007"], "http://x/a; 7"),
    (["http://x/a;1.50;-0;1e5"], "http://x/a; 1.5; -0; 100000"),
    (["http://x/a;nan;inf;5d"], "http://x/a; NaN; inf; 5d"),
    (["9007199254740993"], "9007199254740992"),
    (["18446744073709551616"], "18446744073709551616"),
    (["123456789012345678901234567890"], "123456789012345677877719597056"),
    (["9" * 400], "inf"),
    (["http://x/;0.0000001"], "http://x/; 0.0000001"),
    (["http://x/;0.00000000000000000001;-0.5;12345678.5"], "http://x/; 0.00000000000000000001; -0.5; 12345678.5"),
    (["http://x/;1e-300"], "http://x/; 0." + "0" * 299 + "1"),
    (["9" * 39], str(int(float("9" * 39)))),
    (["9" * 40], str(int(float("9" * 40)))),
    (["7" * 300], str(int(float("7" * 300)))),
    ([str(2**1023 + 2**990)], str(int(float(2**1023 + 2**990)))),
    ([str(2**126)], str(2**126)),
])
def test_format_entities(spark, given_, want):
    df = spark.createDataFrame([(given_,)], "e array<string>")
    assert df.select(text.format_entities(F.col("e"))).first()[0] == want


def test_token_splits(spark):
    df = spark.createDataFrame([("a  <DATE> bc",), ("",), (None,)], "t string")
    rows = df.select(
        text.split_on_blank(F.col("t")).alias("b"), text.split_on_whitespace(F.col("t")).alias("w"),
        text.split_on_word_pattern(F.col("t")).alias("p"),
    ).collect()
    assert [list(r) for r in rows] == [
        [["a", "", "<DATE>", "bc"], ["a", "<DATE>", "bc"], ["date", "bc"]], [[""], [], []], [[""], [], []],
    ]


def test_term_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],)], "t array<string>")
    rows = [r[0] for r in df.select(text.term_counts(F.col("t"))).collect()]
    assert [[tuple(c) for c in r] for r in rows] == [[("a", 1), ("b", 2)], []]
