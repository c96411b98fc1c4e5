"""Connected components of a table of links."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored

#: Links that one task contracts.
TASK_LINKS = 250_000


def _stars(batches):
    """Links of one task as links (u, v) from each node to the least node it reaches by them."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            root.setdefault(a, a)
            root.setdefault(b, b)
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
    ends = [(x, find(x)) for x in root]
    u, v = [x for x, r in ends if x != r], [r for x, r in ends if x != r]
    yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def components(links: DataFrame, most_rounds: int = 60, task_links: int = TASK_LINKS) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a, b), root the least node reachable.

    Tasks of at most about ``task_links`` links each first contract their own
    links to stars. Where there are several tasks, alternating star contraction
    joins them: a round hangs larger neighbours, then smaller ones, on the least
    node they know (a join with an aggregate of one row per node, so a hub's
    links are split like any skewed join); rounds grow with the logarithm of the
    longest path. State is checkpointed every round.
    """
    links = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    )
    tasks = max(1, -(-links.count() // task_links))
    spread = links.coalesce(1) if tasks == 1 else links.repartition(tasks)
    edges = stored(spread.mapInArrow(_stars, "u long, v long"))
    seen = None
    for _ in range(most_rounds if tasks > 1 else 0):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        if tasks > 1:
            raise RuntimeError("components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
