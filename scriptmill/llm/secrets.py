"""Secret scans: fixed patterns, and a character convolutional network over every candidate.

A candidate is any run of 16 or more key characters. The network sees the
characters of the candidate and of its surroundings (one-hot classes, one
convolution, max and mean pooling, one hidden layer; plain numpy) and gives a
calibrated probability. It is trained, with a fixed seed, on labelled findings
generated here from formats: no labels of secrets come with the tables.
Calibration is a logistic fit; the threshold is the highest that keeps
``RECALL`` of the positives with 95 % confidence. Training, calibration and threshold each use
findings of their own. A trained network can be kept as a table
(:func:`to_table`, :func:`from_table`) and given to the scans.

A candidate longer than the network's window is scored window by window with
overlap and takes the highest score, so texts and candidates count whole.
Spans of the fixed patterns always stay; the network only adds spans, of kind
``model``: a candidate, or what fixed spans leave of it. Beside an assignment,
whose span holds the whole value, less than a candidate's length does not count.

Defined cases: a null text is empty and has no spans; rows are independent, so
repeated rows, ties, null ids and further columns do not matter; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from scriptmill.llm.batches import map_texts, replace_texts, schema_of

KINDS = ("assign", "access", "hex", "model")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{CANDIDATE},}}")
LEFT, BODY, RIGHT = 24, 40, 8
RECALL = 0.97
WINDOWS = 8192  # scored at once


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; runs of hex digits or of an access key that are too short match nothing, so the minimum stands in the pattern."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    return sorted(out + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)])


# --- the network -----------------------------------------------------------

def _classes() -> np.ndarray:
    """Class of a character code below 128: digits, vowels and consonants of either case in small groups, punctuation one by one; 0 is padding, the last all other characters."""
    table = np.full(129, 1, np.int64)
    for i, group in enumerate(["0123456789", "aeiou", "bcdfg", "hjklm", "npqrst", "vwxyz", "AEIOU", "BCDFG", "HJKLM", "NPQRST", "VWXYZ", " ", "\n\t\r", "=", ":", "\"'", "/", "+", "_", "-", ".", ",;!?"], 2):
        for ch in group:
            table[ord(ch)] = i
    table[128] = 24
    return table


_CLASS = _classes()
N_CLASSES, WIDTH, FILTERS, HIDDEN = 25, 5, 24, 16
LENGTH = LEFT + BODY + RIGHT


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """The network's inputs for a candidate: one for each overlapping part of at most BODY characters."""
    out = []
    for a in range(start, max(start + 1, end - BODY // 2), BODY // 2):
        b = min(end, a + BODY)
        row = np.zeros(LENGTH, np.int64)
        for at, piece in ((LEFT - min(LEFT, a), text[max(0, a - LEFT) : a]), (LEFT, text[a:b]), (LEFT + BODY, text[b : b + RIGHT])):
            row[at : at + len(piece)] = _CLASS[np.minimum(np.frombuffer(piece.encode("utf-32-le"), np.uint32), 128)]
        out.append(row)
        if b == end:
            break
    return out


@dataclass
class Network:
    conv: np.ndarray  # (WIDTH * classes, FILTERS)
    conv_b: np.ndarray
    hidden: np.ndarray  # (2 * FILTERS + own features, HIDDEN)
    hidden_b: np.ndarray
    out: np.ndarray
    out_b: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def features(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Convolution by table look-up: a one-hot input selects rows of the kernel."""
        w = self.conv.reshape(WIDTH, N_CLASSES, FILTERS)
        n = LENGTH - WIDTH + 1
        z = np.broadcast_to(self.conv_b, (len(x), n, FILTERS)).copy()
        for j in range(WIDTH):
            z += w[j][x[:, j : j + n]]
        a = np.maximum(z, 0)
        top = a.argmax(1)
        return a, top, np.concatenate([np.take_along_axis(a, top[:, None, :], 1)[:, 0], a[:, LEFT : LEFT + BODY].mean(1)], 1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        f = self.features(x)[2]
        return np.maximum(f @ self.hidden + self.hidden_b, 0) @ self.out + self.out_b

    def scores(self, x: np.ndarray) -> np.ndarray:
        parts = [1 / (1 + np.exp(-(self.scale * self.logits(x[i : i + 512]) + self.shift))) for i in range(0, len(x), 512)]
        return np.concatenate(parts) if parts else np.zeros(0)


def _word(rng, n: int) -> str:
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "rt", "ve", "sch", "ung", "keit", "ment", "tion", "ing", "ly", "que", "eau", "ción", "ado"]
    return "".join(rng.choice(parts) for _ in range(n))


def labelled_findings(n: int, seed: int) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) of n generated findings, half of them secrets in the usual formats, half look-alikes."""
    rng = np.random.default_rng(seed)
    alpha = {"b62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "b64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "hex": "0123456789abcdef", "up": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "HEX": "0123456789ABCDEF"}
    draw = lambda kind, k: "".join(rng.choice(list(alpha[kind]), k))
    prose = lambda: " ".join(_word(rng, rng.integers(1, 4)) for _ in range(rng.integers(2, 6)))
    out = []
    for i in range(n):
        label = i % 2
        if label:
            kind = rng.integers(7)
            body = (draw("b62", rng.integers(20, 48)), draw("b64", rng.integers(20, 60)), rng.choice(["sk_live_", "sk-", "gh" + "p_", "xox" + "b-", "glpat-"]) + draw("b62", rng.integers(20, 40)), draw("up", rng.integers(20, 33)), draw("HEX", rng.integers(24, 49)), ".".join(["ey" + draw("b62", rng.integers(16, 30)) for _ in range(3)]), draw("b62", 12) + "-" + draw("b62", rng.integers(10, 24)))[kind]
            before = rng.choice(["key = ", "auth: ", "Bearer ", "credential=", "export KEY=", "", "", "", "client_id: ", "x-key: '"])
        else:
            kind = rng.integers(9)
            body = (_word(rng, rng.integers(7, 14))[:60], _word(rng, rng.integers(7, 12)).capitalize(), draw("hex", 1) + "".join(rng.choice(list("0123456789"), rng.integers(15, 24))), "mail%d.example.com" % rng.integers(100), "www." + _word(rng, 4) + ".org/" + _word(rng, 3), "/".join(_word(rng, 2) for _ in range(rng.integers(3, 7))), "-" * int(rng.integers(16, 50)), "_".join(_word(rng, 2) for _ in range(rng.integers(3, 6))), _word(rng, rng.integers(8, 12)).upper())[kind]
            before = rng.choice(["", "", "", "see ", "at ", "key = ", "the "])
        body = body.encode("ascii", "ignore").decode()
        body += "x" * max(0, 16 - len(body)) if not label else ""
        head = f"{prose()} {before}"
        out.append((f"{head}{body}{rng.choice([' ', '.', chr(10), ', ', chr(39)])}{prose()}", len(head), len(head) + len(body), label))
    return out


def _inputs(findings) -> tuple[np.ndarray, np.ndarray]:
    return np.stack([windows(t, a, b)[0] for t, a, b, _ in findings]), np.array([x[3] for x in findings], float)


@cache
def trained(n: int = 3000, epochs: int = 6, seed: int = 7) -> Network:
    """Train, calibrate and set the threshold. Deterministic; a few seconds."""
    rng = np.random.default_rng(seed)
    x, y = _inputs(labelled_findings(n, seed))
    init = lambda *s: rng.normal(0, np.sqrt(2 / s[0]), s)
    net = Network(init(WIDTH * N_CLASSES, FILTERS) * 3, np.zeros(FILTERS), init(2 * FILTERS, HIDDEN), np.zeros(HIDDEN), init(HIDDEN, 1)[:, 0], 0.0)
    names = ("conv", "conv_b", "hidden", "hidden_b", "out", "out_b")
    m = {k: np.zeros_like(np.asarray(getattr(net, k), float)) for k in names}
    v, t, one_hot = {k: z.copy() for k, z in m.items()}, 0, np.eye(N_CLASSES)
    for _ in range(epochs):
        order = rng.permutation(n)
        for i in range(0, n, 100):
            xs, ys, t = x[order[i : i + 100]], y[order[i : i + 100]], t + 1
            a, top, f = net.features(xs)
            h = f @ net.hidden + net.hidden_b
            r = np.maximum(h, 0)
            p = 1 / (1 + np.exp(-(r @ net.out + net.out_b)))
            dz = (p - ys) / len(ys)
            dh = np.outer(dz, net.out) * (h > 0)
            df = dh @ net.hidden.T
            da = np.zeros_like(a)
            np.put_along_axis(da, top[:, None, :], df[:, None, :FILTERS], 1)
            da[:, LEFT : LEFT + BODY] += df[:, None, FILTERS:] / BODY
            da *= a > 0
            hot, flat = one_hot[xs], da.reshape(-1, FILTERS)
            dw = np.stack([hot[:, j : j + a.shape[1]].reshape(-1, N_CLASSES).T @ flat for j in range(WIDTH)])
            grads = {"conv": dw.reshape(-1, FILTERS), "conv_b": da.sum((0, 1)), "hidden": f.T @ dh, "hidden_b": dh.sum(0), "out": r.T @ dz, "out_b": dz.sum()}
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g**2
                setattr(net, k, getattr(net, k) - 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8))
    xc, yc = _inputs(labelled_findings(n // 2, seed + 1))
    z = net.logits(xc)
    a, b = 1.0, 0.0
    for _ in range(300):  # logistic calibration by gradient steps
        e = 1 / (1 + np.exp(-(a * z + b))) - yc
        a, b = a - 0.05 * (e * z).mean(), b - 0.05 * e.mean()
    net.scale, net.shift = a, b
    xt, yt = _inputs(labelled_findings(n // 2, seed + 2))
    allowed = 1 - RECALL - 1.64 * np.sqrt(RECALL * (1 - RECALL) / yt.sum())  # so that RECALL holds beyond these findings, with 95 % confidence
    net.threshold = float(np.quantile(net.scores(xt)[yt == 1], allowed, method="lower"))
    return net


def to_table(spark: SparkSession, net: Network) -> DataFrame:
    """The weights as rows (name, shape, values)."""
    rows = [(f.name, list(np.shape(getattr(net, f.name))), np.ravel(getattr(net, f.name)).astype(float).tolist()) for f in fields(net)]
    return spark.createDataFrame(rows, "name string, shape array<int>, values array<double>")


def from_table(df: DataFrame) -> Network:
    """The network of :func:`to_table`: nine rows."""
    return Network(**{r.name: np.array(r["values"]).reshape(r["shape"]) if r["shape"] else r["values"][0] for r in df.collect()})


# --- the scan --------------------------------------------------------------

def _outside(start: int, end: int, touching) -> tuple[tuple[int, int], ...]:
    """The parts of a candidate outside the fixed spans that touch it; beside assignments only those of a candidate's length."""
    least = 1 if any(k for _, k, _ in touching) else CANDIDATE
    out, at = [], start
    for a, _, b in touching:
        out.append((at, a))
        at = max(at, b)
    return tuple((a, b) for a, b in [*out, (at, end)] if b - a >= least)


def candidates(text: str, base) -> Iterator[tuple[int, int, tuple]]:
    """(start, end, parts outside fixed spans) of every candidate, in one walk along both sorted lists."""
    active, at = [], 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while at < len(base) and base[at][0] < b:
            active.append(base[at])
            at += 1
        active = [s for s in active if s[2] > a]
        yield a, b, _outside(a, b, active)


def scan(texts: list[str], net: Network) -> list[list[tuple[int, int, int]]]:
    """All spans (start, kind, end) of each text, by start and then kind. Every candidate is scored, windows of many of them at a time."""
    found, rows, owners = [base_spans(x) for x in texts], [], []

    def judge():
        scores = net.scores(np.stack(rows))
        for i, parts in {owners[j] for j in np.flatnonzero(scores >= net.threshold).tolist()}:
            found[i] += [(a, 3, b) for a, b in parts]
        rows.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for a, b, parts in candidates(text, found[i][:]):
            for w in windows(text, a, b):
                rows.append(w)
                owners.append((i, parts))
                if len(rows) >= WINDOWS:
                    judge()
    if rows:
        judge()
    return [sorted(set(x)) for x in found]


def render(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(df: DataFrame, keep: list[str], text: str = "text", net: Network | None = None) -> DataFrame:
    """Kept columns, counts of the fixed kinds, the digest of the fixed spans, and all spans."""
    shared = df.sparkSession.sparkContext.broadcast(net or trained())

    def make():
        def fn(texts):
            found = scan(texts, shared.value)
            base = [[s for s in x if s[1] < 3] for x in found]
            out = {f"n_{k}": [sum(s[1] == i for s in x) for x in base] for i, k in enumerate(KINDS)}
            out["base_sha256"] = [hashlib.sha256(render(x).encode()).hexdigest() for x in base]
            out["spans"] = [render(x) for x in found]
            out["n_model"] = [len(x) - len(y) for x, y in zip(found, base, strict=True)]
            return out

        return fn

    return map_texts(df, make, keep, text, schema_of(df, keep, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long"))


def redact(text: str, spans) -> str:
    """The text with each span replaced by its kind in brackets; of touching spans the first counts."""
    out, at = [], 0
    for a, k, b in spans:
        if b > at:
            out += [text[at : max(a, at)], f"[{KINDS[k]}]" if a >= at else ""]
            at = b
    return "".join([*out, text[at:]])


def redact_secrets(df: DataFrame, text: str = "text", net: Network | None = None) -> DataFrame:
    """The rows of ``df`` with every span in their texts redacted; null texts stay null."""
    shared = df.sparkSession.sparkContext.broadcast(net or trained())

    def make():
        return lambda texts: [redact(x, s) for x, s in zip(texts, scan(texts, shared.value), strict=True)]

    return replace_texts(df, make, text)
