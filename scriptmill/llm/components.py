"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.runtime import Workspace

MAX_ROUNDS = 60


def _large(e: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, ws: Workspace, label: str = "edges") -> DataFrame:
    """(u, root): the smallest node of its component for every node but the roots.

    ``edges`` has two comparable columns u and v. Minimum per node is a partial
    aggregate joined back, so a node with very many neighbours is not gathered
    anywhere; each round is a table in the shared folder. Rounds are
    logarithmic in the size of a component. Only two sums reach the driver.
    """
    e = ws.save(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{label}0")
    print_ = lambda x: tuple(x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = print_(e)
    for i in range(1, MAX_ROUNDS + 1):
        if not before[0]:
            break
        e = ws.save(_small(ws.save(_large(e), f"{label}{i}l")), f"{label}{i}")
        now = print_(e)
        if now == before:
            break
        before = now
        ws.drop(f"{label}{i}l", f"{label}{i - 1}")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select("u", F.col("v").alias("root"))
