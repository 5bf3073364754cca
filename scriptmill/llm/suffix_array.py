"""Exact removal of repeated 100-byte strings with distributed suffix arrays.

A string of 100 bytes is routed by its own content: of the 69 overlapping
32-grams in it, the rightmost one with the smallest hash is its anchor. Equal
strings have equal anchors, so all occurrences of a string meet in the shard
of its anchor, and anchors that occur once prove that their strings do not
repeat. What reaches a shard are segments: the bytes of all consecutive
strings that share one anchor, about 135 bytes for 35 strings.

Identical segments are found first: all segments are put in order over the
cluster, by their bytes and then by place, and adjacent ones are compared, across
the borders of tasks too; all but the earliest are marked whole. Equal segments
may spread over any number of tasks, so none is too common. A shard then sorts
the suffixes of its distinct segments by the difference-cover algorithm
(:mod:`difference_cover`) and compares adjacent prefixes of 100 bytes; of each
class of equal prefixes all but the earliest string (document, then start) are
marked.

Whole copies, known by their SHA-256, are set apart before: of equal texts the
first document stays and the others lose all their bytes, and an anchor counts
as repeated only if it occurs in different texts or at different places. All
other comparisons are of bytes; hashes only choose where strings meet.

An anchor with more than ``HOT`` bytes of distinct segments does not go to one
task: its strings are put in the same order over the cluster instead. The limit
leaves room for what is sorted beside an anchor, so no shard outgrows the packed
triples. ``hot=-1`` sorts everything this way.

Phases are tables in the shared folder. No text, anchor or link reaches the
driver.

Defined cases: a null text is empty; texts under 100 bytes lose nothing; with
null or repeated keys, rows are ordered by key (nulls first), then text, equal
rows in any order, and each row is a document; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.batches import schema_of, slices
from scriptmill.llm.difference_cover import MAX_SYMBOLS, suffix_array
from scriptmill.runtime import Workspace, ship

LENGTH, GRAM = 100, 32
GRAMS = LENGTH - GRAM + 1
SHARD_BYTES = 1_000_000  # bytes sorted at once
HOT = MAX_SYMBOLS - SHARD_BYTES  # bytes of an anchor's segments with their separators
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    r = a * _A
    r += b
    r ^= r >> np.uint64(29)
    r *= _B
    return r


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number (a view)."""
    return np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(document number, first start, number of starts, anchor hash) of all maximal runs of strings with one anchor."""
    lengths = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data) - LENGTH + 1
    if n <= 0:
        return tuple(np.zeros(0, d) for d in (np.int64, np.int64, np.int64, np.uint64))
    h = _mix(_eights(data)[:-8], _eights(data)[8:])
    h = _mix(h[:-16], h[16:])
    low, width = h, 1
    while width * 2 <= GRAMS:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: n], low[GRAMS - width : GRAMS - width + n])
    # an anchor ends where the minimum changes or an equal one enters on the right
    cut = h[GRAMS - 1 : GRAMS - 1 + n] == low
    cut[1:] |= low[1:] != low[:-1]
    starts = ends - lengths
    cut[starts[(lengths > 0) & (starts < n)]] = True
    at = np.flatnonzero(cut)
    doc = np.searchsorted(ends, at, "right")
    until = np.minimum(np.append(at[1:], n), ends[doc] - LENGTH + 1)
    ok = until > at
    at, doc, until = at[ok], doc[ok], until[ok]
    return doc, at - starts[doc], until - at, low[at]


def repeats(segments: list[bytes], firsts: np.ndarray) -> np.ndarray:
    """Marks, over the string starts of all distinct segments in order, those that are not the earliest of their class; ``firsts`` ranks every start by (document, start)."""
    counts = np.array([len(s) - LENGTH + 1 for s in segments], np.int64)
    data = np.frombuffer(b"\0".join(segments) + bytes(8), np.uint8)
    symbols = data[:-8].astype(np.int64) + 1
    begin = np.cumsum(counts + LENGTH) - (counts + LENGTH)  # a segment has counts + LENGTH - 1 bytes and a separator
    symbols[(begin + counts + LENGTH - 1)[:-1]] = 0
    number = np.full(len(symbols), -1, np.int64)  # of each string start
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    number[np.repeat(begin, counts) + inside] = np.arange(counts.sum())
    order = suffix_array(symbols)
    order = order[number[order] >= 0]
    words, same = _eights(data), np.ones(len(order) - 1, bool)
    for j in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        same &= words[order[1:] + j] == words[order[:-1] + j]
    group = np.flatnonzero(np.concatenate([[True], ~same]))
    ranks = firsts[number[order]]
    least = np.repeat(np.minimum.reduceat(ranks, group), np.diff(np.append(group, len(order))))
    marked = np.zeros(len(firsts), bool)
    marked[number[order]] = ranks != least
    return marked


def _runs(marked: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last place of each run of marks with one owner."""
    on = np.concatenate([[False], marked, [False]])
    turn = np.flatnonzero(on[1:] != on[:-1])
    a, b = turn[::2], turn[1::2]
    inner = np.flatnonzero(marked[1:] & marked[:-1] & (owner[1:] != owner[:-1])) + 1
    return np.sort(np.concatenate([a, inner])), np.sort(np.concatenate([b, inner]))


def _shard(ids: np.ndarray, starts: np.ndarray, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first start, number of starts) of the marked runs among the segments of some anchors."""
    place: dict[bytes, int] = {}
    which = np.fromiter((place.setdefault(s, len(place)) for s in segments), np.int64, len(segments))
    order = np.lexsort((starts, ids))
    _, first = np.unique(which[order], return_index=True)
    earliest = order[first]  # of each distinct segment
    counts = np.fromiter((len(s) - LENGTH + 1 for s in segments), np.int64, len(segments))
    copy = np.ones(len(segments), bool)
    copy[earliest] = False
    out = [(ids[copy], starts[copy], counts[copy])]
    if len(place) > 1 or counts[earliest].sum() > 1:
        each = counts[earliest]
        total = int(each.sum())
        owner = np.repeat(np.arange(len(place)), each)
        begin = starts[earliest][owner] + np.arange(total) - np.repeat(np.cumsum(each) - each, each)
        rank = np.empty(total, np.int64)
        rank[np.lexsort((begin, ids[earliest][owner]))] = np.arange(total)
        a, b = _runs(repeats(list(place), rank), owner)
        out.append((ids[earliest][owner[a]], begin[a], b - a))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _sort_shards(batches):
    """Rows (anchor, segment, id, start), sorted by anchor, in; marked runs out. Whole anchors are sorted together, up to SHARD_BYTES at once."""
    names = ["id", "start", "n"]
    held: list[list] = [[], [], []]
    hashes: list[int] = []
    size = 0

    def work(n):
        ids, starts, segments = np.array(held[0][:n], np.int64), np.array(held[1][:n], np.int64), held[2][:n]
        for x in (*held, hashes):
            del x[:n]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _shard(ids, starts, segments)], names=names)

    for b in batches:
        for part in slices(b, 1, 4096, SHARD_BYTES // 4):
            h, segments = part.column(0).to_pylist(), part.column(1).to_pylist()
            hashes += h
            held[0] += part.column(2).to_pylist()
            held[1] += part.column(3).to_pylist()
            held[2] += segments
            size += sum(map(len, segments))
            if size >= SHARD_BYTES and hashes[0] != hashes[-1]:
                n = len(hashes)
                while hashes[n - 1] == hashes[-1]:
                    n -= 1
                yield work(n)
                size = sum(map(len, held[2]))
    if hashes:
        yield work(len(hashes))


def _identified(df: DataFrame, ws: Workspace, key: str, text: str) -> DataFrame:
    """(_id, key, text): _id is unique and orders documents by key, then text. Unique integer keys serve themselves."""
    rows = df.select(F.col(key), F.col(text).alias("_text"))
    if df.schema[key].dataType.typeName() in ("long", "integer", "short", "byte"):
        odd = rows.groupBy(key).agg(F.count("*").alias("_n")).filter((F.col("_n") > 1) | F.col(key).isNull())
        if not odd.head(1):
            return rows.select(F.col(key).cast("long").alias("_id"), key, "_text")
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    return ws.save(rows.repartitionByRange(key, "_tie").sortWithinPartitions(key, "_text").select(F.monotonically_increasing_id().alias("_id"), key, "_text"), "documents")


def _anchor_table(docs: DataFrame) -> DataFrame:
    """(h, _id, same, same2, run): every anchor run; ``same`` and ``same2`` are 128 bits of the text's digest, ``run`` packs first start and number of starts."""
    def run(batches):
        for b in batches:
            for part in slices(b, 1, 4096, 1 << 20):
                ids, texts = part.column(0).to_numpy(), [(x or "").encode() for x in part.column(1).to_pylist()]
                same = np.frombuffer(b"".join(hashlib.sha256(x).digest()[:16] for x in texts), np.int64).reshape(-1, 2)
                doc, start, n, h = anchors(texts)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[doc]), pa.array(same[doc, 0]), pa.array(same[doc, 1]), pa.array(start << 8 | n)], names=["h", "_id", "same", "same2", "run"])

    return docs.select("_id", "_text").mapInArrow(run, "h long, _id long, same long, same2 long, run long")


def _cut_segments(joined: DataFrame) -> DataFrame:
    """The bytes of the listed runs of each document."""
    def run(batches):
        for b in batches:
            for part in slices(b, 1, 64):
                out = [[], [], [], []]
                for i, text, rows in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    raw = text.encode()
                    starts = [r["run"] >> 8 for r in rows]
                    out[0] += [r["h"] for r in rows]
                    out[1] += [raw[a : a + (r["run"] & 255) + LENGTH - 1] for a, r in zip(starts, rows, strict=True)]
                    out[2] += [i] * len(rows)
                    out[3] += starts
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.binary(), pa.int64(), pa.int32()), strict=True)], names=["h", "segment", "_id", "start"])

    return joined.select("_id", "_text", "_runs").mapInArrow(run, "h long, segment binary, _id long, start int")


def _adjacent(batches):
    """Rows (bytes, _id, start, h) of one range in order: which of them have the bytes of the row before. Bytes stay on rows that are not later ones, and on the first and last row of the range (edge 1 and 2, or 3), which are compared with other ranges afterwards."""
    names = ["bytes", "_id", "start", "h", "size", "later", "edge"]
    held, before, first = None, None, True

    def out(part, ending):
        nonlocal before, first
        s, n = part.column(0), part.num_rows
        same = np.zeros(n, bool)
        same[0] = before is not None and s[0].as_py() == before
        if n > 1:
            same[1:] = pc.equal(s.slice(1), s.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        edge = np.zeros(n, np.int32)
        edge[0] += first
        edge[-1] += 2 * ending
        before, first = s[n - 1].as_py(), False
        return pa.RecordBatch.from_arrays([pc.if_else(pa.array(~same | (edge > 0)), s, pa.scalar(None, s.type)), part.column(1), part.column(2), part.column(3), pc.binary_length(s), pa.array(same), pa.array(edge)], names=names)

    for b in batches:
        if b.num_rows:
            if held is not None:
                yield out(held, False)
            held = b
    if held is not None:
        yield out(held, True)


def _in_order(rows: DataFrame, ws: Workspace, label: str) -> tuple[DataFrame, DataFrame]:
    """Of rows (bytes, _id, start, h), sorted over the cluster by all but h: the earliest of each class of equal bytes, and (_id, start, size) of all others."""
    order = ["bytes", "_id", "start"]
    judged = ws.save(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_adjacent, "bytes binary, _id long, start int, h long, size int, later boolean, edge int"), f"{label}_judged")
    at, edges = F.struct("_id", "start"), judged.filter("edge > 0")
    last = edges.filter("edge > 1").groupBy("bytes").agg(F.min(at).alias("_last"))
    moved = ws.save(edges.filter("edge <> 2 AND NOT later").join(last, "bytes").filter(F.col("_last") < at).select("_id", "start", "size"), f"{label}_moved")  # at most one row a range
    own = judged.filter("NOT later").join(moved.select("_id", "start"), ["_id", "start"], "left_anti").select("bytes", "_id", "start", "h")
    return own, judged.filter("later").select("_id", "start", "size").unionByName(moved)


def _runs_of(later: DataFrame) -> DataFrame:
    return later.select("_id", F.col("start").cast("long").alias("start"), (F.col("size") - LENGTH + 1).cast("long").alias("n"))


def _marked(segments: DataFrame, ws: Workspace, hot: int) -> DataFrame:
    """(_id, start, n): the marked runs. Identical segments are all marked but the earliest; what is left is sorted shard by shard, or string by string where an anchor has too much of it."""
    own, copies = _in_order(segments.select(F.col("segment").alias("bytes"), "_id", "start", "h"), ws, "segments")
    large = ws.save(own.groupBy("h").agg(F.sum(F.octet_length("bytes") + 1).alias("_n")).filter(F.col("_n") > hot).select("h"), "large")
    split = bool(large.head(1))
    cold = own.join(large, "h", "left_anti") if split else own
    cold = cold.repartition("h").sortWithinPartitions("h").select("h", F.col("bytes").alias("segment"), "_id", "start")
    marked = cold.mapInArrow(_sort_shards, "id long, start long, n long").withColumnRenamed("id", "_id").unionByName(_runs_of(copies))
    if split:
        strings = own.join(large, "h", "left_semi").select("bytes", "_id", "start", "h", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - LENGTH)).alias("_j"))
        strings = strings.select(F.substring("bytes", F.col("_j") + 1, F.lit(LENGTH)).alias("bytes"), "_id", (F.col("start") + F.col("_j")).alias("start"), "h")
        marked = marked.unionByName(_runs_of(_in_order(strings, ws, "strings")[1]))
    return marked


def _strip(joined: DataFrame, key: str, schema) -> DataFrame:
    """Digests of what is left of each document without its marked strings; a copy keeps nothing."""
    def run(batches):
        for b in batches:
            for part in slices(b, 1, 256):
                out = [[], [], [], []]
                for text, runs, copy in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    raw, spans = (text or "").encode(), 0
                    kept, end, removed = hashlib.sha256(), 0, 0
                    marked = [(0, len(raw))] if copy and len(raw) >= LENGTH else sorted((r["start"], r["start"] + r["n"] + LENGTH - 1) for r in runs or ())
                    for r in marked:
                        if r[0] > end or not spans:
                            kept.update(raw[end : r[0]])
                            spans, end, removed = spans + 1, r[1], removed + r[1] - r[0]
                        elif r[1] > end:
                            removed, end = removed + r[1] - end, r[1]
                    kept.update(raw[end:])
                    for x, v in zip(out, (len(raw), removed, spans, kept.hexdigest()), strict=True):
                        x.append(v)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))], names=schema.fieldNames())

    return joined.select(key, "_text", "_runs", "_copy").mapInArrow(run, schema)


def _copies(docs: DataFrame, ws: Workspace) -> DataFrame:
    """(_id, _copy) of the documents whose text an earlier one has."""
    texts = ws.save(docs.select("_id", F.unhex(F.sha2(F.encode(F.coalesce("_text", F.lit("")), "utf-8"), 256)).alias("_name")), "texts")
    first = ws.save(texts.groupBy("_name").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").select("_name", "_first"), "first")
    return ws.save(texts.join(first, "_name").filter("_id <> _first").select("_id", F.lit(True).alias("_copy")), "copies")


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256): every byte of a 100-byte string that also starts earlier is removed."""
    ship(df.sparkSession)
    ws = Workspace(df.sparkSession, "suffixes")
    docs = _identified(df, ws, key, text)
    copies = _copies(docs, ws)
    found = ws.save(_anchor_table(docs), "anchors")
    place = ("same", "same2", "run")
    spans = found.groupBy("h").agg(*(f(c).alias(f"{f.__name__}_{c}") for c in place for f in (F.min, F.max)))
    often = ws.save(spans.filter(" OR ".join(f"min_{c} <> max_{c}" for c in place)).select("h"), "often")
    runs = found.join(often, "h").groupBy("_id").agg(F.collect_list(F.struct("h", "run")).alias("_runs")).join(copies, "_id", "left_anti")
    runs = ws.save(runs, "repeated")
    ws.drop("anchors", "often")
    ws.sweep()
    segments = ws.save(_cut_segments(docs.join(runs, "_id")), "segments")
    ws.drop("repeated")
    ws.sweep()
    marked = ws.save(_marked(segments, ws, hot).groupBy("_id").agg(F.collect_list(F.struct("start", "n")).alias("_runs")), "marked")
    ws.drop("segments")
    ws.sweep()
    return _strip(docs.join(marked, "_id", "left").join(copies, "_id", "left"), key, schema_of(docs, [key], "n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def op3_sql() -> str:
    """DuckDB: every 100-byte string as hex digits, all but the first of equal ones marked, marks merged to spans."""
    return f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, i, substr(h, 2 * i + 1, {2 * LENGTH}) AS s FROM (SELECT rid, h, unnest(range(0, length(h) // 2 - {LENGTH - 1})) AS i FROM d WHERE length(h) >= {2 * LENGTH})),
later AS (SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY s ORDER BY rid, i) AS n FROM w) WHERE n > 1),
e AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) + {LENGTH} AS upto FROM later),
g AS (SELECT rid, i, sum(CASE WHEN upto IS NULL OR i > upto THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS g FROM e),
r AS (SELECT rid, g, min(i) AS a, max(i) + {LENGTH} AS b FROM g GROUP BY 1, 2),
k AS (SELECT rid, string_agg(part, '' ORDER BY a) AS kept FROM (SELECT rid, a, substr(h, 2 * o + 1, 2 * (a - o)) AS part FROM (SELECT *, lag(b, 1, 0) OVER (PARTITION BY rid ORDER BY a) AS o FROM r) JOIN d USING (rid)) GROUP BY 1),
t AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS past FROM r GROUP BY 1)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN past IS NULL THEN h ELSE kept || substr(h, 2 * past + 1) END)) AS kept_sha256
FROM d LEFT JOIN t USING (rid) LEFT JOIN k USING (rid)"""
