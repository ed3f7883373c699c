"""Connected components of an edge table by contraction."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.groups import column
from zonecast.llm.shared import bounded, materialize

CHUNK_EDGES = 1_000_000        # edges that a task contracts at a time


def spanning_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(smallest node, node)`` for every other node of each component of these edges."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[:len(a)], code[len(a):]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        apart = low != high
        if not apart.any():
            break
        x, y, low, high = x[apart], y[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    other = root != np.arange(len(nodes))
    return nodes[root[other]], nodes[other]


def _contract(batches):
    def star(parts):
        a, b = spanning_stars(*(np.concatenate([column(p, c).to_numpy() for p in parts]) for c in ("a", "b")))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    parts, rows = [], 0
    for batch in batches:
        parts.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK_EDGES:
            yield star(parts)
            parts, rows = [], 0
    if rows:
        yield star(parts)


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node with an edge to another (columns ``a``, ``b``); equal labels mean connected.

    Each round every task first reduces the edges it reads, chunk by chunk, to
    stars around their smallest nodes.  Then every node points to the
    neighbour (itself included) that comes first, and edges are rewritten to
    those representatives; loops go.  "First" is by id in even rounds, which
    takes a star in one round, and by a hash of the round in odd ones, which
    shortens paths of any numbering by a constant share.  Nothing but row
    counts reaches the driver.  A node with very many neighbours is reduced by
    a partial aggregate.  Rows with a null end and loops are ignored, repeated
    edges count once; an empty table gives no rows.
    """
    live = materialize(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b"), "cc-edges")
    labels = None
    turn = 0
    while not live.isEmpty():
        live = materialize(live.mapInArrow(_contract, "a long, b long"), "cc-stars")
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def order(c, turn=turn):
            return F.struct((F.xxhash64(F.col(c), F.lit(turn)) if turn % 2 else F.col(c)).alias("o"), F.col(c).alias("n"))
        first = materialize(both.groupBy("a").agg(F.min(order("b")).alias("x"))
                            .select(F.col("a").alias("from"), F.least("x", order("a"))["n"].alias("to")), "cc-map")
        hop = bounded(first)
        ends = live.join(hop, live["a"] == hop["from"]).select(F.col("to").alias("a"), "b")
        ends = ends.join(hop, ends["b"] == hop["from"]).select("a", F.col("to").alias("b"))
        live = materialize(ends.where("a <> b"), "cc-edges")
        if labels is None:
            labels = first.select(F.col("from").alias("node"), F.col("to").alias("label"))
        else:
            labels = materialize(labels.join(hop, labels["label"] == hop["from"], "left")
                                 .select("node", F.coalesce("to", "label").alias("label")), "cc-labels")
        turn += 1
    return labels if labels is not None else live.select(F.col("a").alias("node"), F.col("b").alias("label"))
