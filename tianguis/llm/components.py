"""Connected components of a link table by alternating stars, with unions inside the tasks first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tianguis.llm.common import discard, stored

LINK = "a bigint, b bigint"
#: Links that a task unites at a time; what it keeps from one portion to the next are spanning links.
PORTION = 200_000


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node) that connect the same nodes as the links (a, b)."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = root[root]
        if np.array_equal(root, before):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each portion of links by at most one link for each node in it."""
    held: list[np.ndarray] = []
    count = 0

    def flush():
        a, b = spanning(*np.concatenate(held, axis=1))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        held.append(np.stack([np.asarray(batch.column(i), dtype=np.int64) for i in (0, 1)]))
        count += batch.num_rows
        if count >= PORTION:
            yield flush()
            held, count = [], 0
    if count:
        yield flush()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node of its component.

    Links are contracted inside the tasks, then large-star and small-star rounds alternate until nothing
    changes; their number grows with the logarithm of the longest chain. Each round reduces by key with
    partial minima and joins them back; Spark splits a hub in that join. Null and self links are ignored, an
    empty table gives an empty result, repeated links change nothing.
    """
    links = links.select("a", "b").where("a <> b")
    links = stored(links.mapInArrow(contract, LINK).distinct())
    state = None
    while True:
        both = links.union(links.select("b", "a"))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").groupBy("a", "b").agg(F.lit(1)).select("a", "b")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", "low"), F.struct(F.col("b").alias("a"), "low"))).alias("x"))
        before, links = links, stored(small.selectExpr("x.a as a", "x.low as b").where("a <> b").distinct())
        discard(before)
        new = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
