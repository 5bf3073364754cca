"""Suffix arrays against sorting, removal of repeats against a direct scan."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scriptmill.llm import suffix_array as S
from scriptmill.llm.difference_cover import suffix_array
from scriptmill.runtime import Workspace


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=80))
def test_suffix_array(x):
    assert suffix_array(np.array(x, np.int64)).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def direct(rows):
    """Rows (key, text) in document order."""
    seen, out = set(), []
    for key, text in rows:
        raw = (text or "").encode()
        marks = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                marks[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        spans = sum(marks[i] and not (i and marks[i - 1]) for i in range(len(raw)))
        out.append((key, len(raw), sum(marks), spans, hashlib.sha256(bytes(b for b, m in zip(raw, marks) if not m)).hexdigest()))
    return out


def corpus():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(40) for _ in range(4)]
    docs = [prose(rng.randint(0, 60)) for _ in range(30)]
    docs += [f"{prose(10)} {rng.choice(passages)} {prose(10)} {rng.choice(passages)[: rng.randint(80, 150)]}" for _ in range(40)]
    docs += ["a" * 350, "a" * 120, "ab" * 200, "", "short", "x" * 99, "x" * 100, "y" * 100, "y" * 100]
    docs += [docs[3], docs[35], docs[35]] + [passages[0]] * 5
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("hot", [S.HOT, 2000, -1])
def test_removal(spark, hot):
    rows = list(enumerate(corpus()))
    got = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_bytes", "'x' AS h").repartition(5), hot=hot)
    assert sorted(tuple(r) for r in got.collect()) == direct(rows)


def test_odd_keys(spark):
    texts = ["p" * 30 + str(i) * 100 for i in range(3)]
    rows = [(None, texts[0]), (2, texts[1]), (2, texts[1]), (2, texts[0]), (1, None), (None, texts[2]), (1, texts[2])]
    got = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    per_key = lambda x: sorted((k is not None, k or 0, n, removed) for k, n, removed, *_ in x)
    assert sum(r.n_removed for r in got) == sum(x[2] for x in direct(order))
    assert [x[:3] for x in per_key(got)] == [x[:3] for x in per_key(direct(order))]
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_anchors_cover_every_string():
    texts = [t.encode() for t in corpus()]
    doc, start, n, h = S.anchors(texts)
    by_string = {}
    for d, s, k, x in zip(doc, start, n, h):
        for i in range(s, s + k):
            by_string.setdefault(texts[d][i : i + 100], set()).add(x)
    assert int(n.sum()) == sum(max(0, len(t) - 99) for t in texts)
    assert all(len(x) == 1 for x in by_string.values())


@pytest.mark.parametrize("n", [5_000, 15_000, 30_000])
def test_anchor_of_many_distinct_segments(spark, n):
    """A passage in n documents with other bytes around it in each: one anchor, with at most or with more bytes than one sort takes."""
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    pool = letters(300_000)
    data = np.frombuffer(pool.encode(), np.uint8)
    h = S._mix(S._eights(data)[:-8], S._eights(data)[8:])
    at = int(S._mix(h[:-16], h[16:]).argmin())  # a passage that is the anchor of all strings around it
    sides = [(letters(70), letters(70)) for _ in range(n)]
    sides[-100:] = [(a, letters(70)) for a, _ in sides[:100]]
    rows = [(i, a + pool[at : at + S.GRAM] + b) for i, (a, b) in enumerate(sides)]
    got = sorted(tuple(r) for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    assert got == direct(rows) and sum(x[2] > 0 for x in got) == 100


def test_one_string_everywhere(spark):
    """Equal strings that fill several ranges of the global order: the first row of a range is compared with the range before."""
    rows = [(bytes([65 + i % 3]) * 100, i, j) for i in range(3000) for j in range(2)]
    df = spark.createDataFrame([(bytearray(a), i, j) for a, i, j in rows], "bytes binary, _id long, start int").selectExpr("*", "7L AS h").repartition(7)
    own, later = S._in_order(df, Workspace(spark, "order"), "x")
    assert sorted((bytes(r.bytes), r._id, r.start) for r in own.collect()) == [(bytes([65 + i]) * 100, i, 0) for i in range(3)]
    got = [tuple(r) for r in later.collect()]
    assert len(got) == len(set(got)) == len(rows) - 3
