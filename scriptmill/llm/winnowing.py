"""Benchmark decontamination by winnowing.

Word k-grams (k = 5) are hashed, and of every 6 consecutive k-grams, which
together cover the 10 words of a window, the smallest hash is kept. Two texts
that share 10 consecutive words share such a window, hence a kept fingerprint
at the same place of it; so every sufficiently long shared span is found.
An item shorter than a window is one window; its fingerprint is the hash of all
its words, and documents offer the hashes of all grams of the lengths that such
items have.

Fingerprints of both sides are tables with the words around them (as many as a
window can reach), and are joined by their hash; Spark picks the join by size
and may split it where a fingerprint is very common. Each hit is extended word
by word within its context; at least a window of equal words is an occurrence,
anything less is not. Every occurrence of a window holds a kept fingerprint, so
the extended hits together cover exactly the occurrences. Equal contexts of one
text are one row with all their places, so a text that repeats itself does not
meet another one pairwise.

Documents are read once. What they offer to the join is thinned by a bitmap of
the benchmark's hashes, ``2**BITMAP_BITS`` bits (8 MB) whatever the benchmark's
size: a bit that is not set proves that a hash cannot join. No part of the
benchmark reaches the driver but this bitmap and the list of lengths below 10.

Defined cases: null texts have no words and no hits; items without words match
nothing; equal items each count, null item ids as "null"; equal or null
document ids stay separate rows; empty tables on either side give no hits or no
rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.batches import map_texts, schema_of, slices
from scriptmill.llm.bitmap import BITS, bitmap, known
from scriptmill.runtime import Workspace, ship

WINDOW, K = 10, 5
BITMAP_BITS = BITS
MEMO = 100_000
_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 32 for b in range(256))
_PRIME = np.uint64(0x100000001B3)


def words_of(text: str) -> list[bytes]:
    """ASCII letters lower-cased; words are runs of ASCII letters, digits and all non-ASCII characters."""
    return text.encode().translate(_TABLE).split()


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all k-grams of word numbers."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x, h = ids.astype(np.uint64), np.full(n, k, np.uint64)
    for j in range(k):
        h = (h ^ x[j : j + n]) * _PRIME
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: the rightmost smallest hash of every ``window`` consecutive ones (of all, if fewer)."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64)
    w = min(window, n)
    view = np.lib.stride_tricks.sliding_window_view(hashes[::-1], w)
    return np.unique(n - 1 - (np.arange(n - w + 1) + view.argmin(1)))


class Grams:
    """Word hashes of texts; words are hashed once."""

    def __init__(self):
        self.memo: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def offered(hashes: np.ndarray, lengths: list[int], keep=None) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(size, places, gram hashes) that a text of these word hashes offers: its winnowed k-grams as size K, and all grams of the given short lengths as their length negated; ``keep`` thins hashes."""
    grams = gram_hashes(hashes, K)
    at = winnow(grams, WINDOW - K + 1) if len(hashes) >= WINDOW else np.zeros(0, np.int64)
    out = [(K, at, grams[at])]
    for m in lengths:
        h = gram_hashes(hashes, m) ^ np.uint64(m)
        out.append((-m, np.arange(len(h)), h))
    if keep is not None:
        out = [(m, at[ok], h[ok]) for m, at, h in out for ok in [keep(h)]]
    return out


def contexts(words: list[bytes], found) -> dict[tuple[int, int, bytes], list[int]]:
    """Places by (hash, words before the gram, context); a short gram, marked by -1 words before it, is its own context."""
    out: dict[tuple[int, int, bytes], list[int]] = {}
    for m, places, hashes in found:
        for p, h in zip(places.tolist(), hashes.view(np.int64).tolist(), strict=True):
            first, end = (max(0, p - WINDOW + K), p + WINDOW) if m > 0 else (p, p - m)
            out.setdefault((h, p - first if m > 0 else -1, b" ".join(words[first:end])), []).append(p)
    return out


def extend(lead: int, context: bytes, lead2: int, context2: bytes) -> tuple[int, int] | None:
    """Words before and behind the place of a hit that both contexts share, if they make a window."""
    if (lead < 0) != (lead2 < 0):
        return None
    a, b = context.split(), context2.split()
    if lead < 0:
        return (0, len(a)) if a == b else None
    left, right = 0, 0
    while left < min(lead, lead2) and a[lead - left - 1] == b[lead2 - left - 1]:
        left += 1
    while lead + right < len(a) and lead2 + right < len(b) and a[lead + right] == b[lead2 + right]:
        right += 1
    return (left, right) if right >= K and left + right >= WINDOW else None


SPANS = "array<struct<start:int,end:int>>"
_PRINT = "h long, lead int, context binary"


def _prints(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, short, h, lead, context): the distinct fingerprints of every item; ``short`` is its length below a window, else 0."""
    ship(items.sparkSession)

    def run(batches):
        grams = Grams()
        for b in batches:
            for part in slices(b, 1):
                out = [[], [], [], [], []]
                for name, t in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = words_of(t or "")
                    if not words:
                        continue
                    short = len(words) if len(words) < WINDOW else 0
                    for h, lead, context in contexts(words, offered(grams(words), [short] if short else [])):
                        for x, v in zip(out, (name, short, h, lead, context), strict=True):
                            x.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["item", "short", "h", "lead", "context"])

    return items.select(F.coalesce(F.col(item).cast("string"), F.lit("null")), text).mapInArrow(run, f"item string, short int, {_PRINT}")


def _offers(docs: DataFrame, keep: list[str], text: str, prints: DataFrame) -> DataFrame:
    """Kept columns, n_words, and the fingerprints (hash, context, places) that the bitmap leaves."""
    lengths = sorted(r.short for r in prints.filter("short > 0").select("short").distinct().collect())  # at most WINDOW - 1
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(prints, "h", BITMAP_BITS))

    def make():
        grams = Grams()

        def fn(texts):
            words = [words_of(x) for x in texts]
            found = [contexts(w, offered(grams(w), lengths, lambda h: known(shared.value, h))) for w in words]
            return {"n_words": list(map(len, words)), "_offers": [[{"h": h, "lead": lead, "context": c, "at": at} for (h, lead, c), at in x.items()] for x in found]}

        return fn

    return map_texts(docs, make, keep, text, schema_of(docs, keep, f"n_words long, _offers array<struct<{_PRINT.replace(' ', ':').replace(',:', ',')},at:array<int>>>"))


def _hits(offers: DataFrame, prints: DataFrame, keep: list[str]) -> DataFrame:
    """(kept columns, item, spans): for each joined and extended pair of contexts the runs of words that it covers."""
    ship(offers.sparkSession)
    rows = offers.select(*keep, F.explode("_offers").alias("_o")).select(*keep, "_o.h", F.col("_o.lead").alias("_lead"), F.col("_o.context").alias("_context"), F.col("_o.at").alias("_at"))
    met = rows.join(prints.select("h", "item", "lead", "context"), "h").select(*keep, "item", "_at", "_lead", "_context", "lead", "context")
    schema = schema_of(met, [*keep, "item"], f"spans {SPANS}")

    def run(batches):
        n = len(keep) + 1
        for b in batches:
            for part in slices(b, n, 4096):
                found = [extend(*x) for x in zip(*(part.column(i).to_pylist() for i in range(n + 1, n + 5)), strict=True)]
                use = pa.array([x is not None for x in found], pa.bool_())
                spans = [_union((p - x[0], p + x[1]) for p in at) for at, x in zip(part.column(n).filter(use).to_pylist(), filter(None, found), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i).filter(use) for i in range(n)), _span_array(spans)], names=schema.fieldNames())

    return met.mapInArrow(run, schema)


def contamination(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated, spans, items) of every document: ``spans`` are the maximal runs of hit words, ``items`` the sorted ids."""
    ws = Workspace(df.sparkSession, "winnow")
    prints = ws.save(_prints(benchmark, item, item_text), "prints")
    offers = ws.save(_offers(df.select(F.col(key).alias("_key"), text), ["_key"], text, prints).withColumn("_row", F.monotonically_increasing_id()), "offers")
    hits = ws.save(_hits(offers.filter(F.size("_offers") > 0), prints, ["_row"]), "hits")
    # spans and items by themselves: many items with equal spans bring those once
    spans = hits.groupBy("_row").agg(F.collect_set("spans").alias("_spans")).mapInArrow(_union_rows, f"_row long, spans {SPANS}")
    items = hits.groupBy("_row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = offers.select("_row", "_key", "n_words").join(spans, "_row", "left").join(items, "_row", "left")
    empty = F.array().cast("array<string>")
    out = out.select(F.col("_key").alias(key), "n_words", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"), F.coalesce("items", empty).alias("items"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))
    return out.select(key, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "spans", "items")


def _union(spans) -> list[tuple[int, int]]:
    """Sorted maximal runs of the words in any span."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _union_rows(batches):
    """Rows (_row, array of span arrays): their spans made runs."""
    for b in batches:
        for part in slices(b, 1):
            rows = [_union((s["start"], s["end"]) for x in r for s in x) for r in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), _span_array(rows)], names=["_row", "spans"])


def _span_array(rows) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in r] for r in rows], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df`` without any benchmark window. A window is in a text or not, whatever row holds it, so rows go by the digest of their text."""
    ws, name = Workspace(df.sparkSession, "winnow"), "__winnow_text"
    digest = F.sha2(F.col(text), 256)
    prints = ws.save(_prints(benchmark, item, item_text), "prints")
    texts = df.filter(F.col(text).isNotNull()).select(digest.alias(name), text)
    offers = ws.save(_offers(texts, [name], text, prints).filter(F.size("_offers") > 0).drop("n_words"), "offers")
    bad = ws.save(_hits(offers, prints, [name]).select(name).distinct(), "bad")
    return df.withColumn(name, digest).join(bad, name, "left_anti").select(*df.columns)


def op2_sql() -> str:
    """DuckDB: every window as a list of words, matched by equality."""
    words = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
    return rf"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, {words} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS m FROM bw),
dw AS (SELECT doc_id, i, m, list_slice(w, i, i + m - 1) AS win FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, m, item_id FROM dw JOIN bw USING (win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hits)) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""
