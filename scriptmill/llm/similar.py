"""Near copies by SimHash and exact similarity: Jaccard of at least 4/5 on five-word shingles.

SimHash comes first: fingerprints of five-word shingles, linked by the index of
:mod:`simhash`, and each of its links verified on the whole sets. It cannot
find all similar pairs: at a similarity of 0.8 fingerprints
differ in about 10 bits, often in a bit of every byte, so no number of shared
bytes holds for all of them. The pairs that it leaves apart come from prefixes: with all
shingles in one common order, two sets of similarity 4/5 or more share one
among the first ``n - ceil(4n/5) + 1`` of each. Shingles that a sample of
documents repeats come last in the order, so that common lines post little;
the sample changes the cost, never the result. Every candidate is verified on
the whole sets, and components are taken over the pairs that hold.

A dense group shares whole lists. Each list is first compared with one of its
members, where SimHash has not put both into one component. Nodes that are then still in different components are compared with
each other by sizes, places and parity signatures, which lose no similar pair:
first each node with the ``NEAREST`` nearest of a list, which joins dense groups
by few pairs, then, in lists that have more, with all that are possible. Only pairs that
pass become rows. In long texts nearly all shingles differ and fill a short
signature, so pairs pass once more by signatures as long as the sets, which
travel with pairs and not with postings; all that are left are verified. Lists are found
by one shuffle of the postings, in a walk that holds two rows of a list; lists
that the sample shows to be common are dealt to ``PIECES`` tasks, each with a
member to compare with of its own.

Shingles and texts stand as 64-bit hashes. Defined cases: as in
:mod:`simhash`; equal texts are one node, all texts without words another, and
a text of fewer than five words is one shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.llm import simhash
from scriptmill.llm.batches import map_texts, schema_of, slices
from scriptmill.llm.bitmap import bitmap, known
from scriptmill.llm.components import components
from scriptmill.runtime import Workspace, ship

SHINGLE, SEED = 5, 42
MEMO = 200_000
SAMPLE, COMMON = 10_000, 300_000  # documents in the sample, shingles taken from it
NEAREST = 2
PARITY = 1024  # bits of a node's signature in lists; the wide one of a larger set has as many as it has elements, or up to twice as many
OFTEN, PIECES = 50, 64  # documents of the sample that make a list a common one, its pieces
_A = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Sorted distinct shingle hashes of texts; words are hashed once."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.memo = size, {}

    def __call__(self, text: str) -> np.ndarray:
        words, memo = text.encode().lower().split(), self.memo
        if not words:
            return np.zeros(0, np.int64)
        if len(memo) > MEMO:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh64_intdigest(w, SEED)
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(h))
        out = np.full(len(h) - size + 1, size, np.uint64)
        for j in range(size):
            out = (out ^ h[j : j + len(out)]) * _A
            out ^= out >> np.uint64(29)
        return np.unique(out.view(np.int64))


def similar(inter, a, b):
    """Whether sets of a and b elements with so many in common reach 4/5."""
    return 9 * inter >= 4 * (a + b)


def _node(text: str):
    """The hash of a text; all texts without words, null among them, are one node."""
    return F.when(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))


def _sets(df: DataFrame) -> DataFrame:
    """(node, set) of (node, text)."""
    def make():
        sets = Shingler()
        return lambda texts: {"set": [sets(x) for x in texts]}

    return map_texts(df, make, ["node"], "text", schema_of(df, ["node"], "set array<long>"))


def _common(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample repeats, sorted, and how often."""
    sample = docs.filter(F.pmod(F.xxhash64("node"), F.lit(max(1, n // SAMPLE))) == 0).dropDuplicates(["node"])
    counts = _sets(sample).select(F.explode("set").alias("h")).groupBy("h").agg(F.count("*").cast("int").alias("n")).filter("n > 1")
    t = counts.orderBy(F.desc("n"), "h").limit(COMMON).toArrow()
    h, c = t.column(0).to_numpy(), t.column(1).to_numpy()
    order = np.argsort(h)
    return h[order], c[order]


def _postings(docs: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(h, piece, node, size, at): the prefix of every set, with places in the common order."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def make():
        sets, (known, counts) = Shingler(), shared.value

        def prefix(text):
            s = sets(text)
            size, often = len(s), np.zeros(len(s), np.int32)
            if len(known):
                i = np.minimum(np.searchsorted(known, s), len(known) - 1)
                often = np.where(known[i] == s, counts[i], 0)
                order = np.lexsort((s, often))
                s, often = s[order], often[order]
            n = size - (4 * size + 4) // 5 + 1
            return s[:n], often[:n] >= OFTEN, size

        def fn(texts):
            out = [prefix(x) for x in texts]
            return {"hs": [x[0] for x in out], "often": [x[1] for x in out], "size": [x[2] for x in out]}

        return fn

    rows = map_texts(docs, make, ["node"], "text", schema_of(docs, ["node"], "hs array<long>, often array<boolean>, size int"))
    rows = rows.select("node", "size", F.posexplode(F.arrays_zip("hs", "often")).alias("at", "_p"))
    piece = F.when(F.col("_p.often"), 1 + F.pmod("node", F.lit(PIECES))).otherwise(0).cast("int")
    return rows.select(F.col("_p.hs").alias("h"), piece.alias("piece"), "node", "size", "at")


_SHARED = "h long, node long, size int, at int, pivot long, pivot_size int, pivot_at int"


def _shared_lists(batches):
    """From rows (h, piece, node, size, at) in order: those of lists with two nodes or more and of all pieces of common lists, once for each node, with the first node. Between batches only the first and the last row of the open list are held."""
    held, sent = None, False  # rows of the open list; whether they went out before

    def some(cols, done):
        """The rows to send; the first ``done`` of them are out."""
        h, piece, node, size, at, first = cols
        count = np.diff(np.append(np.flatnonzero(first), len(first)))
        use = np.repeat(count > 1, count) | (piece > 0)
        use[:done] = False
        pivot = np.repeat(np.flatnonzero(first), count)[use]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (h[use], node[use], size[use], at[use], node[pivot], size[pivot], at[pivot])], names=["h", "node", "size", "at", "pivot", "pivot_size", "pivot_at"])

    for b in batches:
        if not b.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        done = len(held[0]) if held is not None and sent else 0
        h, piece, node = cols[:3]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (piece[1:] != piece[:-1])
        new = first.copy()
        new[1:] |= node[1:] != node[:-1]
        cols, first = [c[new] for c in cols], first[new]
        open_ = int(np.flatnonzero(first)[-1])
        yield some([*cols, first], done)
        sent = len(first) - open_ > 1 or cols[1][open_] > 0
        keep = [open_, len(first) - 1] if len(first) - open_ > 1 else [open_]
        held = [c[keep] for c in cols]


def _list_pairs(most: int | None):
    """From rows (h, node, size, at, root, parity) sorted by h and size: pairs with different roots that sizes, places and parities leave possible; with ``most``, for each row only so many of them, those with the nearest parities, and a row (h, null) for a list of which there are more. A list may span batches."""
    return lambda batches: _pairs_of_lists(batches, most)


def _pairs_of_lists(batches, most):
    names = ["u", "v"]
    held: list[list[np.ndarray]] = []
    cut: set[int] = set()  # lists of which not all possible pairs went out

    def work(h, node, size, at, root, parity):
        us, vs, n = [], [], 0
        edge = np.flatnonzero(h[1:] != h[:-1]) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(h)], strict=True):
            left = size[a:b] - at[a:b]  # an upper bound of what two sets share from here on
            upto = np.searchsorted(size[a:b], size[a:b] * 5 // 4, "right")
            for i in range(b - a - 1):
                j = slice(a + i + 1, a + int(upto[i]))
                ok = np.flatnonzero(similar(np.minimum(left[i], left[i + 1 : upto[i]]), size[a + i], size[j]) & (root[j] != root[a + i])) + a + i + 1
                # similar sets differ in at most a ninth of their sizes together
                if len(ok):
                    unlike = np.bitwise_count(parity[ok] ^ parity[a + i]).sum(1, dtype=np.int64)
                    possible = 9 * unlike <= size[ok] + size[a + i]
                    ok, unlike = ok[possible], unlike[possible]
                    if most and len(ok) > most:
                        ok = ok[np.argpartition(unlike, most)[:most]]
                        cut.add(int(h[a]))
                if len(ok):
                    other = node[ok]
                    us.append(np.maximum(other, node[a + i]))
                    vs.append(np.minimum(other, node[a + i]))
                    n += len(other)
                    if n > 1 << 18:
                        yield us, vs
                        us, vs, n = [], [], 0
        if us:
            yield us, vs

    def rows(cols):
        for us, vs in work(*cols):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=names)
        if cut:
            yield pa.RecordBatch.from_arrays([pa.array(sorted(cut), pa.int64()), pa.nulls(len(cut), pa.int64())], names=names)
            cut.clear()

    for b in batches:
        if not b.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns[:5]]
        now.append(np.frombuffer(b"".join(b.column(5).to_pylist()), np.uint64).reshape(-1, PARITY // 64))
        held.append(now)
        if held[0][0][0] == now[0][-1]:
            continue  # one list so far
        cols = [np.concatenate(x) for x in zip(*held, strict=True)]
        last = int(np.searchsorted(cols[0], cols[0][-1]))
        held = [[c[last:].copy() for c in cols]]
        yield from rows([c[:last] for c in cols])
    if held:
        yield from rows([np.concatenate(x) for x in zip(*held, strict=True)])


def _of_needed(texts: DataFrame, needed: DataFrame, make, columns: str) -> DataFrame:
    """(node, columns) by a function of sets, for the needed nodes and a few others that share their bits of the bitmap."""
    names = ["node", *(x.split()[0] for x in columns.split(", "))]
    shared = texts.sparkSession.sparkContext.broadcast(bitmap(needed, "node"))

    def run(batches):
        sets = Shingler()
        for b in batches:
            b = b.filter(pa.array(known(shared.value, b.column(0).to_numpy())))
            for part in slices(b, 1, size=1 << 20):
                yield pa.RecordBatch.from_arrays([part.column(0), *make([sets(x or "") for x in part.column(1).to_pylist()])], names=names)

    return texts.mapInArrow(run, f"node long, {columns}").dropDuplicates(["node"])


def _whole(sets) -> list[pa.Array]:
    return [pa.array(sets, pa.list_(pa.int64()))]


def _signatures(sets) -> list[pa.Array]:
    return [pa.array([len(s) for s in sets], pa.int32()), parities(sets), wide_parities(sets)]


def parities(sets) -> pa.Array:
    """For each set, which of PARITY classes of hashes hold an odd number of its elements, as bits. Two sets differ in at least as many elements as such bits."""
    bits = np.stack([np.bincount(s & (PARITY - 1), minlength=PARITY) & 1 for s in sets]) if sets else np.zeros((0, PARITY))
    return pa.array([x.tobytes() for x in np.packbits(bits.astype(np.uint8), axis=1)], pa.binary())


def wide_parities(sets) -> pa.Array:
    """The same for sets of more than PARITY elements, by the next power of two that their size does not exceed; null for smaller ones."""
    def odd(s):
        bits = 1 << (len(s) - 1).bit_length()
        return np.packbits((np.bincount(s & (bits - 1), minlength=bits) & 1).astype(np.uint8)).tobytes()

    return pa.array([odd(s) if len(s) > PARITY else None for s in sets], pa.binary())


def unlike(a: bytes, b: bytes) -> int:
    """In how many bits two signatures differ; the longer one is folded to the classes of the shorter one."""
    n = min(len(a), len(b))

    def folded(x):
        bits, x = 8 * len(x), int.from_bytes(x, "big")
        while bits > 8 * n:
            bits //= 2
            x = (x >> bits) ^ (x & ((1 << bits) - 1))
        return x

    return (folded(a) ^ folded(b)).bit_count()


def _verified(pairs: DataFrame, texts: DataFrame, ws: Workspace, label: str) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar."""
    sets = ws.save(_of_needed(texts, pairs.select(F.explode(F.array("u", "v")).alias("node")), _whole, "set array<long>"), f"{label}_sets")
    ws.sweep()
    one, two = (sets.select(F.col("node").alias(x), F.col("set").alias(f"_{x}")) for x in "uv")
    met = pairs.join(one, "u").join(two, "v")
    links = ws.save(met.filter(similar(F.size(F.array_intersect("_u", "_v")), F.size("_u"), F.size("_v"))).select("u", "v"), f"{label}_links")
    ws.drop(f"{label}_sets")
    ws.sweep()
    return links


def _mixed(rows: DataFrame, roots: DataFrame, ws: Workspace, label: str) -> DataFrame:
    """(h, node, size, at, root) of the lists whose nodes are in different components."""
    placed = rows.select("h", "node", "size", "at").join(roots.withColumnRenamed("u", "node"), "node", "left")
    placed = ws.save(placed.select("h", "node", "size", "at", F.coalesce("root", "node").alias("root")), f"{label}_placed")
    mixed = placed.groupBy("h").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).filter("_a <> _b").select("h")
    out = ws.save(placed.join(mixed, "h", "left_semi"), label)
    ws.drop(f"{label}_placed")
    ws.sweep()
    return out


def _parity_allows(pairs: DataFrame, parity: DataFrame) -> DataFrame:
    """The pairs (u, v) whose widest signatures differ in at most a ninth of their sizes together."""
    one, two = (parity.select(F.col("node").alias(x), F.col("size").alias(f"_{x}n"), F.coalesce("wide", "parity").alias(f"_{x}")) for x in "uv")

    def run(batches):
        for b in batches:
            n = np.fromiter(map(unlike, *(b.column(i).to_pylist() for i in (3, 4))), np.int64, b.num_rows)
            yield b.filter(pa.array(9 * n <= b.column(2).to_numpy())).select(["u", "v"])

    met = pairs.select("u", "v").join(one, "u").join(two, "v")
    return met.select("u", "v", (F.col("_un") + F.col("_vn")).alias("sizes"), "_u", "_v").mapInArrow(run, "u long, v long")


def _pairs(rest: DataFrame, parity: DataFrame, most: int | None) -> DataFrame:
    rows = rest.join(parity.select("node", "parity"), "node").select("h", "node", "size", "at", "root", "parity").repartition("h").sortWithinPartitions("h", "size")
    return rows.mapInArrow(_list_pairs(most), "u long, v long").distinct()


def _near_prints(prints: DataFrame, ws: Workspace) -> DataFrame:
    """(u, v) nodes that SimHash links, from (node, fp): nodes of one fingerprint by its first node, and the first nodes of linked fingerprints."""
    firsts = ws.save(prints.groupBy("fp").agg(F.min("node").alias("first")), "prints")  # a table, so that the join with a very common fingerprint can be split
    same = prints.join(firsts, "fp").filter("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    one, two = (firsts.select(F.col("fp").alias(x), F.col("first").alias(f"_{x}")) for x in "uv")
    near = simhash.links(firsts.select("fp"), ws).distinct().join(one, "u").join(two, "v")
    return same.unionByName(near.select(F.greatest("_u", "_v").alias("u"), F.least("_u", "_v").alias("v")))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v) whose nodes are in different components."""
    one, two = (roots.select(F.col("u").alias(x), F.col("root").alias(f"_{x}")) for x in "uv")
    met = pairs.join(one, "u", "left").join(two, "v", "left")
    return met.filter(F.coalesce("_u", "u") != F.coalesce("_v", "v")).select("u", "v")


def classes(df: DataFrame, ws: Workspace, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, kept columns, root, component_id): documents linked by pairs of similarity 4/5 or more; ``root`` names a component also where all its keys are null."""
    ship(df.sparkSession)
    docs = df.select(F.col(key).alias("_key"), *keep, _node(text).alias("node"), F.col(text).alias("_text"))
    docs = ws.save(simhash.fingerprints(docs, ["_key", *keep, "node"], "_text", SHINGLE), "documents")
    texts = df.select(_node(text).alias("node"), F.col(text).alias("text"))  # hashed again where needed: less than writing every text
    nodes = ws.save(docs.groupBy("node").agg(F.min("_key").alias("_least"), F.min("fp").alias("fp")), "nodes")
    near = ws.save(_near_prints(nodes.select("node", "fp"), ws), "near_prints")
    found = _verified(near, texts, ws, "simhash")
    ws.sweep()
    postings = _postings(texts, _common(texts, nodes.count()))
    order = ["h", "piece", "node"]
    shared = ws.save(postings.repartition("h", "piece").sortWithinPartitions(*order).mapInArrow(_shared_lists, _SHARED), "shared")
    ws.sweep()
    parity = ws.save(_of_needed(texts, shared.select("node"), _signatures, "size int, parity binary, wide binary"), "parity")
    left = F.least(F.col("size") - F.col("at"), F.col("pivot_size") - F.col("pivot_at"))  # at most so much is shared from here on
    near = shared.filter((F.col("node") != F.col("pivot")) & similar(left, F.col("size"), F.col("pivot_size")))
    near = near.select(F.greatest("node", "pivot").alias("u"), F.least("node", "pivot").alias("v")).distinct()
    first = ws.save(_apart(_parity_allows(near, parity), components(found, ws, "prints_round")), "first")
    links = found.unionByName(_verified(first, texts, ws, "first"))
    rest = _mixed(shared, components(links, ws, "round"), ws, "mixed")
    ws.drop("shared")
    ws.sweep()
    pairs = ws.save(_pairs(rest, parity, NEAREST), "pairs")
    nearest = ws.save(_parity_allows(pairs.filter("v IS NOT NULL"), parity), "nearest")
    links = links.unionByName(_verified(nearest, texts, ws, "nearest"))
    rest = rest.join(pairs.filter("v IS NULL").select(F.col("u").alias("h")), "h", "left_semi")
    rest = _mixed(rest, components(links, ws, "near"), ws, "dense")
    last = ws.save(_parity_allows(_pairs(rest, parity, None), parity), "last")
    links = links.unionByName(_verified(last, texts, ws, "last"))
    ws.drop("parity", "mixed", "dense")
    ws.sweep()
    roots = components(links, ws, "all")
    named = ws.save(nodes.join(roots, nodes["node"] == roots["u"], "left").select("node", F.coalesce("root", "node").alias("root"), "_least"), "named")
    least = named.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = ws.save(named.join(least, "root").select("node", "root", "component_id"), "components")
    return docs.join(named, "node").select(F.col("_key").alias(key), *keep, "root", "component_id")
