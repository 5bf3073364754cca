"""Sharding by weighted rendezvous hashing of stable record keys (DataFrame functions only).

Each shard draws, from the key alone, a waiting time ``-ln(u) / weight``; the
shard with the shortest time holds the record. A further shard can only take
records whose time it undercuts, so growth moves records into it and nowhere
else, and a shard's share follows its weight.

Defined cases: a null key counts as the string "null"; a null text has no
bytes (size 1, checksum 0); repeated rows get neighbouring slots; an empty
table gives an empty result; columns besides key and text are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A shard is numbered within this many parts, so no task holds a whole shard.
SLOT_PARTS = 4096
_HEX = 13  # hex digits of a draw: 52 bits, exact in a double


def _draw(key: Column, shard: int) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, _HEX)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**_HEX)


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a string key; ``weights[i]`` is the relative capacity of shard i."""
    waits = [F.struct((-F.log(_draw(key, i)) / F.lit(float(w))).alias("wait"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    return F.array_min(F.array(*waits))["shard"] if len(waits) > 1 else F.lit(0)


def assign_shards(df: DataFrame, weights: Sequence[float] = (1.0,) * 8, grown_weight: float = 1.0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard): placement among ``len(weights)`` shards, a gapless slot within the shard, and the placement with one more shard.

    Slots need no global sort: rows are numbered within (shard, part) and
    shifted by the counts of the parts before, a table of
    ``len(weights) * SLOT_PARTS`` rows whatever the input.
    """
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    id_ = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    rows = df.select(F.col(key), F.octet_length(body).cast("long").alias("_bytes"), F.crc32(body).alias("text_crc32"), id_.alias("_id"))
    rows = rows.select(
        key, (F.col("_bytes") + 1).alias("size"), "text_crc32", "_id",
        rendezvous_shard(F.col("_id"), weights).alias("shard"),
        rendezvous_shard(F.col("_id"), [*weights, grown_weight]).alias("grown_shard"),
        (F.conv(F.substring(F.md5(F.concat("_id", F.lit("/"), F.col("text_crc32").cast("string"))), 1, 8), 16, 10).cast("long") % SLOT_PARTS).cast("int").alias("_part"),
    )
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "_part").agg(F.count("*").alias("_n")).select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("shard", "_part").orderBy("_id", "text_crc32")
    numbered = rows.withColumn("_at", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "_part"]).select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_before") + F.col("_at")).cast("long").alias("slot"), "grown_shard")


def op7_sql() -> str:
    """DuckDB: crc32 by its generator polynomial, bit by bit per byte value, and the same draws."""
    def waits(n):
        return "list_sort([" + ", ".join(f"{{'w': -ln((('0x' || substr(md5(id || ':{i}'), 1, {_HEX}))::BIGINT + 0.5) / {16**_HEX}.0), 's': {i}}}" for i in range(n)) + "])[1].s"

    return f"""
WITH RECURSIVE gen(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM gen WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM gen WHERE k = 8),
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, id, (length(h) // 2)::BIGINT AS n, [4294967295::BIGINT] || list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM d),
c AS (SELECT doc_id, id, n, xor(list_reduce(bytes, lambda a, x: xor(a >> 8, crc.t[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32 FROM b, crc),
s AS (SELECT *, {waits(8)} AS shard, {waits(9)} AS grown_shard, (('0x' || substr(md5(id || '/' || text_crc32::VARCHAR), 1, 8))::BIGINT % {SLOT_PARTS}) AS part FROM c)
SELECT doc_id, n + 1 AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  (row_number() OVER (PARTITION BY shard ORDER BY part, id, text_crc32) - 1)::BIGINT AS slot, grown_shard::INTEGER AS grown_shard
FROM s"""
