"""Text functions on columns. All run in the JVM; only Unicode compatibility normalisation needs Python, and only for rows that are not ASCII."""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode text processing takes it, for use inside a character class (fixed values).
SPACE = r"\t-\r\x1c-\x20\x85\xa0  -     　"
#: No-break space, which becomes a space; then the invisible characters that go.
INVISIBLE = " ​‌‍⁠﻿"
WORD = r"\p{L}\p{N}_"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_invisible(c: Column | str) -> Column:
    return F.translate(col(c), INVISIBLE, " ")


def collapse(c: Column | str) -> Column:
    """Every run of white space as one space, none at the ends. Single spaces, nearly all of the runs, are not matched at all."""
    return F.trim(F.regexp_replace(col(c), f"[{SPACE}]{{2,}}|[{SPACE}&&[^ ]]", " "))


def normalize_whitespace(c: Column | str) -> Column:
    return F.coalesce(collapse(normalize_invisible(c)), F.lit(""))


@cache
def _nfkc():
    def normalize(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    return F.pandas_udf(normalize, "string")


def folded(c: Column | str, compatibility: bool = True) -> Column:
    """Text without invisible characters, in NFKC form unless ``compatibility`` is off. ASCII rows have neither and pass as they are; to Python they travel as nulls."""
    c = col(c)
    odd = F.octet_length(c) != F.length(c)
    visible = normalize_invisible(c)
    return F.when(odd, _nfkc()(F.when(odd, visible)) if compatibility else visible).otherwise(c)


def clean_text(c: Column | str, compatibility: bool = True) -> Column:
    """Formatting only, never a word: white space, spaces at punctuation and brackets, ellipses. Null becomes empty. ``compatibility=False`` skips NFKC for text known to be in that form."""
    x = collapse(folded(c, compatibility))
    for pattern, by in (
        (f"[{SPACE}]+([,.;:!?%…])", "$1"),
        (r" ([)\]}])", "$1"),
        (r"([(\[{]) ", "$1"),
        (rf"([,;:])(?=[^{SPACE}\p{{Nd}}])", "$1 "),
        (r"\.{3,}", "…"),
    ):
        x = F.regexp_replace(x, pattern, by)
    return F.coalesce(collapse(x), F.lit(""))


def comparison_key(c: Column | str, compatibility: bool = True) -> Column:
    """Lower case, letters, digits and underscores only, single spaces; for comparing, never for output."""
    return F.coalesce(collapse(F.regexp_replace(F.lower(folded(c, compatibility)), f"[^{WORD}{SPACE}]", " ")), F.lit(""))


def tokens_of_key(key: Column | str) -> Column:
    return F.filter(F.split(col(key), " "), lambda w: w != "")


def word_tokens(c: Column | str, compatibility: bool = True) -> Column:
    return tokens_of_key(comparison_key(c, compatibility))


def join_texts(texts: Column) -> Column:
    """One text from cleaned texts in order: blanks dropped, no space before closing punctuation."""
    joined = F.array_join(F.filter(texts, lambda t: t != ""), " ")
    return F.regexp_replace(joined, f"[{SPACE}]+([,.;:!?])", "$1")


def words_changed(before: Column | str, after: Column | str, compatibility: bool = True) -> Column:
    """Words of ``after`` that ``before`` lacks, sorted."""
    return F.array_sort(F.array_except(word_tokens(after, compatibility), word_tokens(before, compatibility)))


def one_edit(a: Column | str, b: Column | str) -> Column:
    """Whether two words are one edit apart: insertion, deletion, substitution, or a swap of neighbours."""
    a, b = col(a), col(b)
    swapped = lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.length(a)))
    swap = (F.length(a) == F.length(b)) & (F.length(a) > 1) & (a != b) & F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), lambda i: swapped(i) == b)
    return (F.levenshtein(a, b, 1) == 1) | swap


def osa_distance(a: str, b: str, limit: int) -> int | None:
    """Restricted Damerau-Levenshtein distance, or None beyond ``limit``."""
    if abs(len(a) - len(b)) > limit:
        return None
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(rows[-1][j] + 1, row[j - 1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, rows[-2][j - 2] + 1)
            row.append(d)
        if min(row) > limit and min(rows[-1]) > limit:
            return None
        rows = [rows[-1], row]
    return rows[-1][-1] if rows[-1][-1] <= limit else None


def bounded_edit_distance(a: Column | str, b: Column | str, limit: int) -> Column:
    """The distance of :func:`osa_distance` as a column; for a limit of one, without Python."""
    a, b = col(a), col(b)
    if limit == 1:
        return F.when(a == b, 0).when(one_edit(a, b), 1)

    def distance(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else osa_distance(p, q, limit) for p, q in zip(x, y, strict=True)], dtype="Int32")

    near = F.abs(F.length(a) - F.length(b)) <= limit
    return F.pandas_udf(distance, "int")(F.when(near, a), F.when(near, b))


def count_occurrences(text: Column | str, phrase: Column | str) -> Column:
    """Non-overlapping occurrences of a phrase; 0 if either is empty."""
    text, phrase = col(text), col(phrase)
    gone = F.length(text) - F.length(F.replace(text, phrase, F.lit("")))
    return F.when((F.length(text) > 0) & (F.length(phrase) > 0), (gone / F.length(phrase)).cast("long")).otherwise(F.lit(0).cast("long"))


def redact(c: Column | str, literals: tuple[str, ...] = ()) -> Column:
    """Registered secrets and API-key shapes as a fixed mark."""
    x = col(c)
    for s in sorted({s for s in literals if s}, key=len, reverse=True):
        x = F.replace(x, F.lit(s), F.lit("***REDACTED***"))
    return F.regexp_replace(x, r"\b(?:gsk_|sk_)[A-Za-z0-9_\-]{16,}", "***REDACTED***")


def longest_run(words: Column) -> Column:
    """Length of the longest run of equal neighbours in an array."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(s, w):
        now = F.when(w == s["last"], s["now"] + 1).otherwise(1)
        return F.struct(w.alias("last"), now.alias("now"), F.greatest(s["best"], now).alias("best"))

    return F.aggregate(words, start, step, lambda s: s["best"])


def tail_lines(c: Column | str, n: int = 25) -> Column:
    """The last n lines that are not blank."""
    lines = F.filter(F.split(col(c), "\n"), lambda x: F.trim(x) != "")
    return F.array_join(F.slice(lines, F.greatest(F.size(lines) - n + 1, F.lit(1)), n), "\n")


def transcript_text(c: Column | str) -> Column:
    """Text as files hold it: line feeds only, no spaces at line ends, one final line feed."""
    x = F.regexp_replace(F.regexp_replace(col(c), "\r\n?", "\n"), f"[{SPACE}&&[^\n]]+(?=\n|$)", "")
    return F.concat(F.regexp_replace(x, "\n+$", ""), F.lit("\n"))
