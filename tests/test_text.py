"""Text functions against small tables of cases."""

import pytest
from pyspark.sql import functions as F

from scriptmill.functions import similarity, text


def column(spark, values, f, *more):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in sorted(rows.select("i", f(F.col("x"), *more).alias("y")).collect())]


def test_clean_text(spark):
    cases = {
        "  a   b ": "a b", "a b": "a b", "a​b": "ab", "one , two": "one, two", "one,two": "one, two", "3,000": "3,000", "( x )": "(x)", "[ a ] b": "[a] b",
        "wait ....": "wait…", "10 %": "10%", "a;b:c": "a; b: c", "ﬁne １２": "fine 12", "": "", None: "", "Hello World!": "Hello World!", "tab\tand\nline": "tab and line",
    }
    got = column(spark, list(cases), text.clean_text)
    assert got == list(cases.values())
    assert column(spark, got, text.clean_text) == got  # cleaning twice changes nothing


def test_comparison_key_and_tokens(spark):
    assert column(spark, ["Hello, World!", "a_b-c", "  ", None, "Élan ½"], text.comparison_key) == ["hello world", "a_b c", "", "", "élan 1 2"]
    assert column(spark, ["Hello, World!", "", None], text.word_tokens) == [["hello", "world"], [], []]


def test_words_changed(spark):
    df = spark.createDataFrame([("a b c", "a d c d"), ("x", None)], "p string, q string")
    assert [r[0] for r in df.select(text.words_changed("p", "q")).collect()] == [["d"], []]


@pytest.mark.parametrize("limit", [1, 2])
def test_edit_distance(spark, limit):
    words = ["bear", "bare", "beer", "baer", "ber", "bears", "golden", "golen", "", "a", "training", "trading"]
    pairs = [(a, b) for a in words for b in words]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", text.bounded_edit_distance("a", "b", limit).alias("d")).collect()
    for a, b, d in got:
        assert d == _osa(a, b, limit), (a, b)


def _osa(a, b, limit):
    """Plain recursion over prefixes."""
    from functools import cache

    @cache
    def f(i, j):
        if not i or not j:
            return i + j
        d = min(f(i - 1, j) + 1, f(i, j - 1) + 1, f(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d = min(d, f(i - 2, j - 2) + 1)
        return d

    d = f(len(a), len(b))
    return d if d <= limit else None


def test_count_occurrences(spark):
    df = spark.createDataFrame([("aaaa", "aa"), ("abc", ""), ("", "a"), ("a.b a.b", "a.b")], "t string, p string")
    assert [r[0] for r in df.select(text.count_occurrences("t", "p")).collect()] == [2, 0, 0, 2]


def test_redact_runs_lines(spark):
    assert column(spark, ["key sk_0123456789abcdefgh end", "gsk_short", "my pass1"], text.redact, ("pass1",)) == ["key ***REDACTED*** end", "gsk_short", "my ***REDACTED***"]
    assert column(spark, ["a \r\nb\t\r\n\n"], text.transcript_text) == ["a\nb\n"]
    assert column(spark, ["a\n\nb\n"], text.tail_lines, 1) == ["b"]
    df = spark.createDataFrame([(["a", "a", "b", "b", "b"],), ([],)], "w array<string>")
    assert [r[0] for r in df.select(text.longest_run(F.col("w"))).collect()] == [3, 0]


def test_similarity(spark):
    from difflib import SequenceMatcher

    rows = [("", ""), ("a", ""), ("same text", "Same, text!"), ("hello there", "hallo there"), ("x" * 10, "x" * 30)]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(similarity.similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.0, 1.0, SequenceMatcher(None, "hello there", "hallo there").ratio(), 0.0]
