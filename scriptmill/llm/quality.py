"""Quality classifier: histogram gradient-boosted trees over document statistics.

Training takes at most ``MAX_ROWS`` labelled rows (documented bound), chosen by
the hash of their key before any text is read, so the choice does not depend on
partitions. A key stands for one row: of several labels under it the largest
counts, of several texts the one with the smallest hash. Rows whose crc32(key)
mod 5 is 0 are held out. Trees grow on binned statistics with
second-order logistic gradients and are flattened into arrays; scoring walks
all trees of a slice of documents at once.

Defined cases: a null or empty text has statistics zero and a score; rows with
a null label are not used; without any usable label every score is 0.5; equal
or null ids stay separate rows; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.batches import filter_rows, map_texts, schema_of

MAX_ROWS, FOLDS, THRESHOLD = 20_000, 5, 0.3
TREES, DEPTH, BINS, RATE, L2, MIN_ROWS = 80, 4, 64, 0.15, 2.0, 20
SPACE = b" \t\n\x0b\x0c\r"
_GROUPS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": SPACE, "symbol": b"#*$%&|<>", "stop": b".!?", "bang": b"!", "comma": b",;:", "bracket": b"()[]{}", "slash": b"/\\=_@+-~^`", "quote": b"\"'", "high": range(128, 256), "control": [*range(0, 9), *range(14, 32), 127]}
_MEMBER = np.array([[1.0 if b in g else 0.0 for b in range(256)] for g in map(set, _GROUPS.values())]).T
NAMES = ["bytes", "words", "word_len", "long_words", "upper_words", "distinct_words", "top_word", "lines", "line_len", "distinct_lines", "ended_lines", "entropy", "short_words", "repeat_pairs", *_GROUPS]


def statistics(text: str) -> list[float]:
    """The document statistics, in the order of NAMES; all finite."""
    raw = text.encode()
    words = raw.split()
    n, nw = max(1, len(raw)), max(1, len(words))
    lines = [x.strip(SPACE) for x in raw.split(b"\n") if x.strip(SPACE)]
    nl = max(1, len(lines))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    p = counts[counts > 0] / n
    tally = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    return [
        np.log1p(len(raw)), np.log1p(len(words)), lengths.mean(), (lengths > 20).mean(), sum(map(bytes.isupper, words)) / nw, len(tally) / nw, max(tally.values(), default=0) / nw,
        np.log1p(len(lines)), np.log1p(len(raw) / nl), len(set(lines)) / nl, sum(x[-1] in b".!?" for x in lines) / nl, float(-(p * np.log2(p)).sum()), (lengths < 3).mean(), 1 - len(set(zip(words, words[1:]))) / max(1, nw - 1) if nw > 1 else 0.0,
        *(counts @ _MEMBER / n),
    ]


@dataclass
class Trees:
    """Flattened forest: node i of tree t splits ``feature`` at ``cut`` into nodes 2i+1 and 2i+2; ``value`` holds the leaves."""

    feature: np.ndarray  # (trees, 2**DEPTH - 1)
    cut: np.ndarray
    value: np.ndarray  # (trees, 2**DEPTH)
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        t = np.arange(len(self.feature))
        node = np.zeros((len(x), len(t)), np.int64)
        row = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[row, self.feature[t, node]] > self.cut[t, node])
        z = self.prior + self.value[t, node - (2**DEPTH - 1)].sum(1)
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees of fixed depth on histograms of at most BINS quantile bins."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    if not len(y) or y.min() == y.max():
        prior = 0.0 if not len(y) else float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        return Trees(np.zeros((1, inner), np.int64), np.full((1, inner), np.inf), np.zeros((1, leaves)), prior)
    n, f = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(f)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)  # bin b holds values <= edges[b]
    prior = float(np.log(y.mean() / (1 - y.mean())))
    z = np.full(n, prior)
    feature, cut, value = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves))
    flat = binned + np.arange(f) * BINS
    for t in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for depth in range(DEPTH):
            width = 2**depth
            at = (node[:, None] * (f * BINS) + flat).ravel()
            sums = [np.bincount(at, np.repeat(w, f), width * f * BINS).reshape(width, f, BINS) for w in (g, h, np.ones(n))]
            left = [np.cumsum(s, 2)[:, :, :-1] for s in sums]
            total = [s.sum(2, keepdims=True) for s in sums]
            right = [a - b for a, b in zip(total, left, strict=True)]
            gain = left[0] ** 2 / (left[1] + L2) + right[0] ** 2 / (right[1] + L2) - total[0] ** 2 / (total[1] + L2)
            gain[(left[2] < MIN_ROWS) | (right[2] < MIN_ROWS)] = -1
            for j, e in enumerate(edges):
                gain[:, j, len(e):] = -1
            best = gain.reshape(width, -1).argmax(1)
            fj, bj = best // (BINS - 1), best % (BINS - 1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            base = width - 1
            for i in range(width):
                feature[t, base + i] = fj[i]
                cut[t, base + i] = edges[fj[i]][bj[i]] if good[i] else np.inf
            goes = good[node] & (binned[np.arange(n), fj[node]] > bj[node])
            node = 2 * node + goes
        gs, hs = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        value[t] = -RATE * gs / (hs + L2)
        z += value[t][node]
    return Trees(feature, cut, value, prior)


def held_out(key):
    """Rows never learned from."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS) -> Trees:
    """Fit on at most ``max_rows`` labelled rows. The chosen keys are a bounded table, so joining them moves no text but one for each of them."""
    usable = labels.select(key, label).filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(key).agg(F.max(label).alias("_y"))
    chosen = usable.orderBy(F.xxhash64(key), key).limit(max_rows)
    rows = docs.select(key, F.col(text).alias("_text")).join(F.broadcast(chosen), key)
    rows = rows.groupBy(key).agg(F.max("_y").alias("_y"), F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    out = map_texts(rows, lambda: lambda texts: {"x": [statistics(t) for t in texts]}, [key, "_y"], "_text", schema_of(rows, [key, "_y"], "x array<double>"))
    found = sorted((r[0], int(r[1]), r[2]) for r in out.collect())  # at most max_rows
    return fit(np.array([r[2] for r in found]).reshape(-1, len(NAMES)), np.array([r[1] for r in found], float))


def score(docs: DataFrame, trees: Trees, keep: list[str], text: str = "text") -> DataFrame:
    """Kept columns and ``score``, the probability of the good label."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def make():
        return lambda texts: {"score": shared.value.scores(np.array([statistics(t) for t in texts]).reshape(-1, len(NAMES)))}

    return map_texts(docs, make, keep, text, schema_of(docs, keep, "score double"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every document."""
    scored = score(docs, train(docs, labels, key, text), [key], text)
    return scored.select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, key, text))

    def make():
        return lambda texts: shared.value.scores(np.array([statistics(t) for t in texts]).reshape(-1, len(NAMES))) >= THRESHOLD

    return filter_rows(docs, make, text)
