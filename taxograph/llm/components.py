"""Connected components of a link table by local union-find and contraction.

Links are dealt out to tasks of at most LINKS_PER_TASK; each task reduces its own to stars (vertex,
root). What several tasks say about one vertex becomes a link between roots, and the links between
roots are the next round's table, until none is left. No task holds more than its share, no links
or labels reach the driver, and each round is written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxograph.llm.common import rows_in, staged, tasks_for

LINKS_PER_TASK = 1_000_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, root): the least vertex of the component of every other vertex of some links."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(ends[: len(a)].tolist(), ends[len(a) :].tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.array([find(x) for x in range(len(ids))], dtype="i8")
    other = np.flatnonzero(roots != np.arange(len(ids)))
    return ids[other], ids[roots[other]]


def _local(batches):
    a, b = [], []
    for batch in batches:
        a.append(np.asarray(batch.column(0))), b.append(np.asarray(batch.column(1)))
    if a:
        v, r = stars(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(r, pa.int64())], ["v", "r"])


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id each end of links (a, b) can reach.

    The links are read twice, for their count and for their stars; they should be a staged table.

    An end without other links to a vertex than itself is not listed. An empty table gives an empty
    result.
    """
    edges = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    named = None
    parts = tasks = tasks_for(rows_in(links), LINKS_PER_TASK)
    while True:
        found = staged(edges.repartition(parts).mapInArrow(_local, "v bigint, r bigint"), "stars")
        if parts == 1 and named is None:  # one task has seen all links
            return found.toDF("id", "component").union(found.select("r", "r").distinct())
        label = found.groupBy("v").agg(F.min("r").alias("label"))
        label = label if parts == 1 else staged(label, "labels", parts)
        named = label if named is None else staged(named.join(label.toDF("label", "next"), "label", "left").select("v", F.coalesce("next", "label").alias("label")).union(label.join(named, "v", "left_anti")), "labels", parts)
        if parts == 1:
            break
        roots = found.select(F.col("r").alias("v")).distinct()
        apart = found.join(label, "v").filter("r <> label").select(F.col("label").alias("a"), F.col("r").alias("b"))
        kept = label.join(roots, "v", "left_semi").select(F.col("v").alias("a"), F.col("label").alias("b"))
        edges = staged(apart.union(kept).distinct(), "links", parts)
        parts = tasks_for(rows_in(edges), LINKS_PER_TASK)
    # a label is the least of its links, and the least vertex of a component labels itself
    own = named.select(F.col("label").alias("v")).distinct().select("v", F.col("v").alias("label"))
    return staged(named.union(own).groupBy("v").agg(F.min("label").alias("component")).select(F.col("v").alias("id"), "component"), "components", tasks)
