"""SimHash against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from scriptmill.llm import similar
from scriptmill.llm import simhash as S
from scriptmill.llm.components import components
from scriptmill.runtime import Workspace


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for t in ["", "One", "one TWO", "a b c", "a b c d e f a b c", "É e x  y\tz\x1cq w", "w " * 500]:
        assert S.fingerprint(t) == plain(t)


def groups(fps):
    f, root = np.array(fps, np.uint64), list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= 3) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


@pytest.mark.parametrize("hot", [S.HOT, 5])
def test_components_of_fingerprints(spark, hot, monkeypatch):
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in fps[:30]:  # chains and dense groups
        for _ in range(rng.randint(0, 12)):
            for _ in range(rng.randint(1, 4)):
                f ^= 1 << rng.randrange(64)
            fps.append(f)
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    ws = Workspace(spark, "test")
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    got = {r.u: r.root for r in components(S.links(nodes, ws, hot), ws).collect()}
    parts = {}
    for x, g in zip(signed, groups(fps)):
        parts.setdefault(g, set()).add(got.get(x, x))
    assert all(len(p) == 1 for p in parts.values()) and len(set(map(frozenset, parts.values()))) == len(parts)


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base), (3, base), (9, base.upper().replace(" ", "\n ")), (7, None), (8, "  "), (1, "something else entirely here"), (None, base), (5, base)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS root")
    got = S.near_duplicates(df).collect()
    assert len(got) == 8 and {(r.doc_id, r.component_id) for r in got} == {(5, 3), (3, 3), (9, 3), (None, 3), (7, 7), (8, 7), (1, 1)}
    assert {r.fingerprint for r in got if r.doc_id in (7, 8)} == {"0" * 16}
    kept = S.one_per_class(df.select("doc_id", "text"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 7]
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_dense_lists():
    """Look-ups of changes link what comparing all pairs links, also over batches."""
    rng = np.random.default_rng(3)
    for n, free in ((1, [3]), (40, list(range(8, 20))), (300, [*range(5), *range(30, 40)]), (900, list(range(40, 64)))):
        f = np.unique(np.array([sum(1 << b for b in free if rng.random() < 0.5) + (5 << 20) for _ in range(n)], np.uint64))
        u, v = S._changes(f, free)
        assert (np.bitwise_count(u ^ v) <= 3).all()
        parts = {int(x): int(x) for x in f}

        def find(a):
            while parts[a] != a:
                a = parts[a]
            return a

        for a, b in zip(u.tolist(), v.tolist()):
            a, b = find(a), find(b)
            parts[max(a, b)] = min(a, b)
        assert [find(int(x)) for x in f] == [int(f[i]) for i in groups(f)]


def test_one_per_class_keeps_every_component(spark):
    """Repeated and null keys, repeated rows, ties and clashing names: a row of every component stays, and only one."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    texts = [" ".join(word() for _ in range(80)) for _ in range(12)] + ["", " ", "one two"]
    rows = [(rng.choice([None, 5, 5, 7, i]), rng.choice([t, t.upper() if "one" not in t else t, t + " "]), rng.choice(["a", "b", None]), i % 2) for i in range(120) for t in [rng.choice(texts)]]
    rows += rows[:9] + [(5, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, root string, fp int").repartition(4)
    for find in (S.classes, similar.classes):
        got = [tuple(r) for r in S.one_per_class(df, find=find).collect()]
        node = lambda r: " ".join((r[1] or "").lower().split())
        assert sorted(map(node, got)) == sorted({node(r) for r in rows}) and set(got) <= set(rows)
        for r in got:
            keys = [x[0] for x in rows if node(x) == node(r) and x[0] is not None]
            assert r[0] == (min(keys) if keys else None)


def test_long_chain(spark):
    ws = Workspace(spark, "chain")
    n = 300
    got = components(spark.range(n).selectExpr("id AS u", "id + 1 AS v"), ws).collect()
    assert len(got) == n and {r.root for r in got} == {0}
    assert components(spark.range(0).selectExpr("id AS u", "id AS v"), ws, "none").collect() == []
