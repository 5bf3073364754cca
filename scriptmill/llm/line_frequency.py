"""Quality rules by cross-document line frequency.

One pass over the texts takes the base counts of every document and the hashes
of its normalised lines (ASCII lower case, runs of white space as one space,
digits as 0). Lines are then counted by distinct documents of a host, where
documents with the same whole text count once: copies of one document must not
make its own lines look like boilerplate. Lines above the host's limit are
removed, and a document that keeps too little is rejected.

The limit of a host is ``max(min_docs, share * its distinct documents)``.
Counting is by partial aggregates, so neither a hot host nor a hot line meets
in one task; the lines above limits, at most ``lines / min_docs``, are joined
back by (host, line), a join that Spark may split on skew.

Defined cases: a null text has no words; documents without words fail the base
rule; a null host is one host; equal or null ids stay separate rows; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.batches import map_texts, schema_of
from scriptmill.runtime import Workspace

MIN_WORDS, MAX_REPEATED, WINDOW = 10, 20, 5
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: ASCII white space as bytes.split() and the word pattern take it.
SPACE = b" \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that the text holds twice or more. Windows are compared by the ranks of their halves, so exactly."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    # names of windows of 1, 2, 4 words, joined to the window's length from two overlapping ones
    names, length = ids, 1
    while length < window:
        step = min(length, window - length)
        pair = names[: len(names) - step] * np.int64(n + 1) + names[step:]
        _, names = np.unique(pair, return_inverse=True)
        length += step
    counts = np.bincount(names)
    starts = np.flatnonzero(counts[names] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text."""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    chars = len(text) - (len(raw) - len(raw.translate(None, SPACE)))
    return len(words), chars, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words)


def line_hashes(text: str) -> tuple[list[int], list[int], int]:
    """Hashes and word counts of the normalised lines that have words, and the hash of the whole text."""
    hashed = lambda x: xxhash.xxh64_intdigest(x) - (1 << 63)
    raw = text.encode()
    lines = [b" ".join(x) for x in map(bytes.split, raw.translate(_NORMAL).split(b"\n")) if x]
    return [hashed(x) for x in lines], [x.count(b" ") + 1 for x in lines], hashed(raw)


def _make():
    def fn(texts):
        base, lines = [base_counts(x) for x in texts], [line_hashes(x) for x in texts]
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return {k: [x[i] for x in base] for i, k in enumerate(names)} | {"_lines": [x[0] for x in lines], "_sizes": [x[1] for x in lines], "_identity": [x[2] for x in lines]}

    return fn


def quality_rules(df: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text", min_docs: int = 10, share: float = 0.002, min_left: int = MIN_WORDS, max_removed: float = 0.8) -> DataFrame:
    """Base counts, base_failed, the words in removed lines, and kept: the base rule holds, at least ``min_left`` words stay and at most ``max_removed`` of the words go."""
    ws = Workspace(df.sparkSession, "lines")
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, _lines array<long>, _sizes array<int>, _identity long"
    docs = map_texts(df.select(F.col(key).alias(key), F.coalesce(F.col(host).cast("string"), F.lit("\0")).alias("_host"), F.col(text).alias("_text")), _make, [key, "_host"], "_text", schema_of(df.select(key, F.lit("").alias("_host")), [key, "_host"], counts))
    docs = ws.save(docs.withColumn("_row", F.monotonically_increasing_id()), "documents")
    lines = docs.select("_row", "_host", "_identity", F.explode(F.arrays_zip("_lines", "_sizes")).alias("_l")).select("_row", "_host", "_identity", F.col("_l._lines").alias("_line"), F.col("_l._sizes").alias("_size"))
    hosts = docs.select("_host", "_identity").distinct().groupBy("_host").agg(F.greatest(F.lit(float(min_docs)), F.count("*") * share).alias("_limit"))
    common = lines.select("_host", "_line", "_identity").distinct().groupBy("_host", "_line").agg(F.count("*").alias("_docs")).filter(F.col("_docs") > min_docs)
    common = common.join(hosts, "_host").filter(F.col("_docs") > F.col("_limit")).select("_host", "_line")
    common = ws.save(common, "common")  # a table of its own, so that the join with it can be split where a line is very common
    removed = lines.join(common, ["_host", "_line"]).groupBy("_row").agg(F.sum("_size").alias("_gone"), F.count("*").alias("_gone_lines"))
    out = docs.drop("_lines", "_sizes", "_identity", "_host").join(removed, "_row", "left").select("*", F.coalesce("_gone", F.lit(0)).alias("n_removed_words"), F.coalesce("_gone_lines", F.lit(0)).alias("n_removed_lines"))
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    left = F.col("n_words") - F.col("n_removed_words")
    out = out.withColumn("kept", ~F.col("base_failed") & (left >= min_left) & (F.col("n_removed_words") <= max_removed * F.col("n_words")))
    return out.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_lines", "n_removed_words")


def op1_sql(min_docs: int = 10, share: float = 0.002, min_left: int = MIN_WORDS, max_removed: float = 0.8) -> str:
    """DuckDB: the same rules over the lines and texts themselves instead of their hashes; a document is its whole text."""
    space = r"[\x20\x09-\x0D]"
    words = f"list_filter(regexp_split_to_array({{}}, '{space}+'), lambda x: x <> '')"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source::VARCHAR, chr(0)) AS host, coalesce(text, '') AS t FROM documents),
b AS (SELECT *, {words.format("t")} AS w, string_split(t, chr(10)) AS raw FROM d),
l AS (SELECT rid, host, unnest(raw) AS line FROM b),
n AS (SELECT rid, host, {words.format(f"translate(line, '{upper}', '{lower}')")} AS lw FROM l),
nl AS (SELECT rid, host, array_to_string(lw, ' ') AS line, len(lw) AS size FROM n WHERE len(lw) > 0),
lim AS (SELECT host, greatest({min_docs}.0, count(DISTINCT t) * {share}) AS lim FROM d GROUP BY 1),
com AS (SELECT host, line FROM (SELECT host, line, count(*) AS c FROM (SELECT DISTINCT nl.host, line, t FROM nl JOIN d USING (rid)) GROUP BY 1, 2) JOIN lim USING (host) WHERE c > {min_docs} AND c > lim),
rem AS (SELECT rid, sum(size) AS gone, count(*) AS gone_lines FROM nl JOIN com USING (host, line) GROUP BY 1),
win AS (SELECT rid, i, list_slice(w, i, i + {WINDOW - 1}) AS g FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM b)),
rep AS (SELECT rid, count(DISTINCT p) AS hit FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM win SEMI JOIN (SELECT rid, g FROM win GROUP BY 1, 2 HAVING count(*) > 1) r ON win.rid = r.rid AND win.g = r.g) GROUP BY 1),
o AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(list_filter(raw, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(raw, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
  coalesce(hit, 0)::BIGINT AS n_repeat_words, coalesce(gone, 0)::BIGINT AS n_removed_words, coalesce(gone_lines, 0)::BIGINT AS n_removed_lines FROM b LEFT JOIN rep USING (rid) LEFT JOIN rem USING (rid))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AND n_words - n_removed_words >= {min_left} AND n_removed_words <= {max_removed} * n_words AS kept FROM o"""
