"""Exact near copies against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from scriptmill.llm import similar, simhash
from scriptmill.runtime import Workspace


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def kept(rows):
    """Smallest key of every component of pairs at 0.8 or more."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted({min(rows[j][0] for j in range(len(rows)) if find(j) == find(i)) for i in range(len(rows))})


@pytest.mark.parametrize("common, often", [(similar.COMMON, similar.OFTEN), (5, 3), (similar.COMMON, 2)])
def test_stage(spark, monkeypatch, common, often):
    monkeypatch.setattr(similar, "COMMON", common)
    monkeypatch.setattr(similar, "OFTEN", often)
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    line = " ".join(word() for _ in range(60))
    texts = [f"{line} " + " ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(12)] + ["", " ", "two words", "Two  words", "a b c d e"]
    for _ in range(14):  # chains of edits around the limit
        now = [word() for _ in range(rng.randint(8, 150))]
        for _ in range(rng.randint(2, 7)):
            texts.append(" ".join(now))
            for _ in range(rng.randint(1, 4)):
                now[rng.randrange(len(now))] = word()
            now = now[rng.randint(0, 3) :]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node").repartition(3)
    got = corpus_pipeline.near_duplicate_stage(spark, df, "")
    assert got.columns == df.columns
    want = kept(rows)
    assert sorted(r.doc_id for r in got.collect()) == want and len(want) < len(rows) - 10


def test_shared_lists():
    """Whatever the borders of batches: every node of a list with two or more, once, beside the list's first."""
    rng = np.random.default_rng(4)
    rows = sorted((int(h), 0, int(n), 10 + int(n), 0) for h, n in zip(rng.integers(0, 40, 300), rng.integers(0, 12, 300)))
    rows += [(99, 0, i, 10 + i, 0) for i in range(50)] + sorted((200, 1 + i % 7, i // 2, 10 + i // 2, 0) for i in range(9)) + [(201, 3, 5, 15, 0), (201, 3, 5, 15, 0)]
    lists = {}
    for h, piece, n, *_ in rows:
        lists.setdefault((h, piece), set()).add(n)
    want = sorted((h, n, 10 + n, 0, min(ns), 10 + min(ns), 0) for (h, piece), ns in lists.items() if len(ns) > 1 or piece for n in ns)
    table = pa.table([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()))], names=list("abcde"))
    for size in (1, 2, 3, 7, 50, 1000):
        got = [tuple(r.values()) for b in similar._shared_lists(table.to_batches(size)) for r in b.to_pylist()]
        assert sorted(got) == want


def test_parities():
    """Signatures never differ in more bits than sets in elements."""
    rng = np.random.default_rng(5)
    for n in (0, 1, 30, 3000):
        a = np.unique(rng.integers(-(1 << 63), 1 << 63, n))
        b = np.unique(np.concatenate([a[: n * 2 // 3], rng.integers(-(1 << 63), 1 << 63, n // 2)]))
        x, y = (np.frombuffer(p, np.uint64) for p in similar.parities([a, b]).to_pylist())
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_wide_parities():
    """Wide signatures of any two lengths never differ in more bits than sets in elements, and tell long unlike sets apart."""
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(-(1 << 63), 1 << 63, n)) for n in (5, 1024, 1025, 2048, 2049, 6000, 9000)]
    sets += [np.unique(np.concatenate([sets[-1][: len(sets[-1]) * 9 // 10], sets[3][:300]]))]
    narrow, wide = similar.parities(sets).to_pylist(), similar.wide_parities(sets).to_pylist()
    assert [x and 8 * len(x) for x in wide] == [None, None, 2048, 2048, 4096, 8192, 16384, 16384]
    assert all(similar.unlike(a, b) == 0 for a, b in zip(narrow, wide) if b)
    best = [b or a for a, b in zip(narrow, wide)]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            n = similar.unlike(best[i], best[j])
            assert n == similar.unlike(best[j], best[i]) <= len(np.setxor1d(a, b))
    assert 9 * similar.unlike(best[5], best[6]) > len(sets[5]) + len(sets[6]) >= 9 * similar.unlike(narrow[5], narrow[6]) > 0


def test_long_texts(spark):
    """Long texts that share passages, some of them beyond the limit of similarity and some not."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    passage = [word() for _ in range(900)]
    texts = []
    for _ in range(6):
        now = [word() for _ in range(rng.randint(1500, 4000))] + passage
        for edits in (0, 10, 60, 60, 150):
            now = list(now)
            for _ in range(edits):
                now[rng.randrange(len(now))] = word()
            texts.append(" ".join(now))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    want = kept(rows)
    assert sorted(r.doc_id for r in got.collect()) == want and 6 <= len(want) < len(rows) - 6


def test_simhash_first(spark, monkeypatch):
    """The stage links by the fingerprints of five-word shingles: without prefixes it joins what they link and the sets confirm, and nothing else."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    texts = ["", "  ", "one two", "One  two"]
    for _ in range(15):  # edits of few words in long texts: few bits
        now = [word() for _ in range(rng.randint(100, 600))]
        texts.append(" ".join(now))
        for _ in range(3):
            now[rng.randrange(len(now))] = word()
            texts.append(" ".join(now))
    texts += [texts[9].upper(), texts[9].replace(" ", "\n")]
    prints = [simhash.fingerprint(t, 5) for t in texts]
    want = {}
    for i in range(len(texts)):
        for j in range(i):
            a, b = shingles(texts[i]), shingles(texts[j])
            if (prints[i] ^ prints[j]).bit_count() <= 3 and len(a & b) >= 0.8 * len(a | b):
                want.setdefault(j, set()).add(i)
                want.setdefault(i, set()).add(j)
    group, places = {}, range(len(texts))
    for i in places:
        if i not in group:
            todo = [i]
            while todo:
                if (j := todo.pop()) not in group:
                    group[j] = i
                    todo += want.get(j, ())
    assert 20 < len(set(group.values())) < len(texts) - 10
    monkeypatch.setattr(similar, "_shared_lists", lambda batches: iter(()))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = similar.classes(df, Workspace(spark, "test"))
    assert {r.doc_id: r.component_id for r in got.collect()} == group


def test_links_of_fingerprints_are_verified(spark, monkeypatch):
    """Texts that share a fingerprint and little else stay apart."""
    rows = [(1, "a b c d e f g h"), (2, "p q r s t u v w"), (3, "p q r s t u v  w"), (4, "k l")]
    monkeypatch.setattr(simhash, "fingerprint", lambda text, size: 5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = similar.classes(df, Workspace(spark, "test"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 2, 3: 2, 4: 4}
