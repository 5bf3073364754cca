"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most 3 bits agree in at least 5 of
their 8 bytes. The index posts every distinct fingerprint under its positional
bytes; a pair's tally is the number of positions where both hold the same
byte, a pair is retained when the tally reaches 5, and then verified bit by
bit. Posting single bytes would put 1/256 of all rows in each list, so lists
are keyed by three positional bytes at once: the eight triples inside the
halves (0-3) and (4-7) suffice, since any 5 of 8 positions have 3 in one half.

A list with more than ``HOT`` fingerprints is posted again under the pairs of
its five other positions; nothing is lost, because a retained pair shares two
of them. Such a list holds five bytes fixed, so it has at most 2**24
fingerprints (128 MB), however many documents there are. Within a list,
fingerprints are compared in blocks; in a list beyond ``DENSE`` with at most 24
bits free, each is looked up under all changes of up to 3 of them instead,
which is linear in the list. What leaves a list is a spanning forest of the
links rather than all pairs: reachability is kept, and the output is linear
however dense a group is.

Equal fingerprints are one node from the start, so copies never meet pairwise.

Defined cases: a null text has no words; texts without words have fingerprint
zero and are linked like any other; a text of fewer than three words is one
shingle; equal ids stay separate rows; null ids are rows whose component is the
smallest non-null id reachable, if any; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.llm.batches import map_texts, schema_of
from scriptmill.llm.components import components
from scriptmill.runtime import Workspace, ship

SHINGLE, SEED, BITS, BYTES_SHARED = 3, 42, 3, 5
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
HOT = 20_000
DENSE = 50_000
BLOCK = 1 << 22  # comparisons at once


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :], strict=False)]
    ones = np.zeros(64, np.int64)
    raw = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(raw), 1 << 16):
        ones += np.unpackbits(raw[i : i + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, keep: list[str], text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Kept columns and ``fp`` (the fingerprint as a signed long)."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return map_texts(df, lambda: lambda texts: {"fp": [signed(fingerprint(x, size)) for x in texts]}, keep, text, schema_of(df, keep, "fp long"))


def _key(positions, fp="fp"):
    """The bytes of a fingerprint at some positions (0 is the lowest) as one number."""
    return sum((F.shiftright(F.col(fp), 8 * p).bitwiseAND(F.lit(255)) * F.lit(1 << (8 * i)) for i, p in enumerate(positions)), F.lit(0).cast("long"))


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Count filter on shared positional bytes, then the bits of what is left."""
    x = a ^ b
    tally = (x.view(np.uint8).reshape(*x.shape, 8) == 0).sum(-1)
    ok = tally >= BYTES_SHARED
    ok[ok] = np.bitwise_count(x[ok]) <= BITS
    return ok


def _changes(fps: np.ndarray, free: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the components of sorted distinct fingerprints which differ in the ``free`` bits only: a look-up for every change of at most BITS of them."""
    n, us, vs = len(fps), [], []
    label, at = np.arange(n), np.arange(n)
    for bits in (c for size in range(1, BITS + 1) for c in combinations(free, size)):
        other = fps ^ np.uint64(sum(1 << b for b in bits))
        j = np.minimum(np.searchsorted(fps, other), n - 1)
        i = np.flatnonzero((fps[j] == other) & (j > at) & (label[j] != label))
        if not len(i):
            continue
        j = j[i]
        us.append(fps[j])
        vs.append(fps[i])
        while (unlike := label[i] != label[j]).any():  # hang the larger label under the smaller one, then shorten all paths
            i, j = i[unlike], j[unlike]
            np.minimum.at(label, np.maximum(label[i], label[j]), np.minimum(label[i], label[j]))
            while (label[label] != label).any():
                label = label[label]
        if not label.any():
            break  # all are one component
    return (np.concatenate(us), np.concatenate(vs)) if us else (fps[:0], fps[:0])


def _forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect exactly the components of one sorted list: a search from node to node, in blocks."""
    free = int(np.bitwise_or.reduce(fps ^ fps[0]))
    if len(fps) > DENSE and free.bit_count() <= 24:
        return _changes(fps, [b for b in range(64) if free >> b & 1])
    left, us, vs = fps, [], []
    while len(left) > 1:
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            step = max(1, BLOCK // len(left))
            now, frontier = frontier[:step], frontier[step:]
            near = _near(now[:, None], left[None, :])
            hit = near.any(0)
            if hit.any():
                us.append(left[hit])
                vs.append(now[near[:, hit].argmax(0)])
                frontier, left = np.concatenate([frontier, left[hit]]), left[~hit]
    return (np.concatenate(us), np.concatenate(vs)) if us else (fps[:0], fps[:0])


def _links(batches):
    """From rows sorted by (list, fp): the links of every list. A list may span batches."""
    names = ["u", "v"]
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def work(c, k, f):
        if len(f) < 2:
            return None
        edge = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(f)]])
        us, vs = [], []
        two = starts[ends - starts == 2]  # most lists: one comparison each, all at once
        if len(two):
            ok = _near(f[two], f[two + 1])
            us.append(f[two + 1][ok])
            vs.append(f[two][ok])
        for a, b in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
            u, v = _forest(f[a:b])
            us.append(u)
            vs.append(v)
        u, v = (np.concatenate(x) if x else f[:0] for x in (us, vs))
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=names) if len(u) else None

    for b in batches:
        now = (b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False).view(np.uint64))
        if not len(now[0]):
            continue
        held.append(now)
        if all(len(h[0]) == 0 or (h[0][0], h[1][0]) == (now[0][-1], now[1][-1]) for h in (held[0], held[-1])):
            continue  # one list so far: nothing to do, and nothing copied again
        c, k, f = (np.concatenate(x) for x in zip(*held, strict=True))
        last = int(np.flatnonzero((c != c[-1]) | (k != k[-1]))[-1]) + 1
        held = [(c[last:].copy(), k[last:].copy(), f[last:].copy())]
        if (out := work(c[:last], k[:last], f[:last])) is not None:
            yield out
    if held and (out := work(*(np.concatenate(x) for x in zip(*held, strict=True)))) is not None:
        yield out


def links(nodes: DataFrame, ws: Workspace, hot: int = HOT) -> DataFrame:
    """(u, v) links between distinct fingerprints ``fp``, enough to connect every component."""
    ship(nodes.sparkSession)
    posted = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("list"), _key(t).alias("key")) for i, t in enumerate(TRIPLES)])).alias("_p")).select("_p.list", "_p.key", "fp")
    sizes = posted.groupBy("list", "key").agg(F.count("*").alias("_n")).filter(F.col("_n") > hot).select("list", "key")
    large = ws.save(sizes, "hot")
    if large.head(1):
        # what stays linear: a hot list is posted under 10 pairs of its other positions
        rest = [[p for p in range(8) if p not in t] for t in TRIPLES]
        more = F.array(*[F.array(*[F.struct(F.lit(100 + 10 * i + j).cast("long").alias("list"), _key(t + pair).alias("key")) for j, pair in enumerate(combinations(r, 2))]) for i, (t, r) in enumerate(zip(TRIPLES, rest, strict=True))])
        deeper = posted.join(large, ["list", "key"], "left_semi").select("fp", F.explode(F.element_at(more, (F.col("list") + 1).cast("int"))).alias("_p")).select("_p.list", "_p.key", "fp")
        posted = posted.join(large, ["list", "key"], "left_anti").select("list", "key", "fp").unionByName(deeper)
    return posted.repartition("list", "key").sortWithinPartitions("list", "key", "fp").mapInArrow(_links, "u long, v long")


def classes(df: DataFrame, ws: Workspace, key: str = "doc_id", text: str = "text", hot: int = HOT, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, kept columns, fp, root, component_id): fingerprints are written once; the rest works on distinct fingerprints. ``root`` names a component also where all its keys are null."""
    docs = ws.save(fingerprints(df, [key, *keep], text), "fingerprints")
    nodes = ws.save(docs.groupBy("fp").agg(F.min(key).alias("_least")), "nodes")
    roots = components(links(nodes.select("fp"), ws, hot), ws)
    placed = ws.save(nodes.join(roots, nodes["fp"] == roots["u"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "_least"), "placed")
    least = placed.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = ws.save(placed.join(least, "root").select("fp", "root", "component_id"), "named")  # a table, so that the join with a very common fingerprint can be split
    return docs.join(named, "fp").select(key, *keep, "fp", "root", "component_id")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id) of every document."""
    out = classes(df, Workspace(df.sparkSession, "simhash"), key, text, hot)
    return out.select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_class(df: DataFrame, key: str = "doc_id", text: str = "text", find=None) -> DataFrame:
    """One row of ``df`` for each component by ``find`` (:func:`classes` unless given): the one with the smallest key (nulls last), then the smallest hash of the whole row; rows equal in all columns count once.

    Rows are told apart by key and hash, not by key alone: rows of different
    components may share a key or have none, and each component keeps its row.
    """
    ws, at = Workspace(df.sparkSession, "simhash"), "__simhash_at"
    whole = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema]  # maps have no hash of their own
    tagged = df.withColumn(at, F.xxhash64(*whole))
    found = (find or classes)(tagged, ws, key, text, keep=(at,))
    best = found.groupBy("root").agg(F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col(at).alias("at"))).alias("_b"))
    best = ws.save(best.select(F.col("_b.key").alias("__simhash_key"), F.col("_b.at").alias("__simhash_best")), "best")
    kept = tagged.join(best, tagged[key].eqNullSafe(best["__simhash_key"]) & (tagged[at] == best["__simhash_best"]), "left_semi")
    return kept.withColumn("__simhash_n", F.row_number().over(Window.partitionBy(key, at).orderBy(at))).filter("__simhash_n = 1").drop(at, "__simhash_n")
