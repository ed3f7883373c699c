"""Approximate nearest neighbours by inner product on robust-pruned directed graphs.

Vectors are dealt by norm class (a factor of 16) and by hash into shards of
bounded size, so that a vector of huge norm does not share a graph with
ordinary ones.  Each shard's graph is built in one task: points are inserted in batches, a greedy beam search from
the entry point proposes neighbours, and robust pruning keeps the nearest and
drops what is closer (by the factor ``ALPHA``) to a kept one than to the point,
so that edges stay diverse.  Inner product becomes Euclidean distance by one
extra coordinate that gives all vectors of a shard the same norm; shards and
queries are scaled by powers of two, so no finite vector overflows.  Queries
are sent to every shard and searched there by the same beam search, candidates
are scored exactly in double precision, and the best of all shards are kept.

Equal vectors are one node that lists its smallest ids, so a vector that
stands in a third of the rows neither floods a graph nor a result.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.groups import binary, by_group, column
from zonecast.llm.shared import bounded, materialize
from zonecast.llm.textbytes import mix, powers

SHARD = 16384               # distinct vectors in one graph
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
ALPHA = 1.2
BATCH = 512
STEP = 4                    # nodes that a beam expands at once
CLASS_BITS = 4              # norms of one graph are within this many powers of two


def _distances(x: np.ndarray, norms: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances (less the query's own norm) from each query to its row of ids; -1 is nowhere."""
    d = norms[ids] - 2 * np.einsum("bkd,bd->bk", x[ids], q, optimize=False)
    return np.where(ids >= 0, d, np.inf)


def beam_search(x, norms, graph, entry: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes met from ``entry`` for a batch of queries: ids and distances, nearest first; -1 pads."""
    n_q = len(q)
    rows = np.arange(n_q)[:, None]
    seen = np.zeros((n_q, len(x) + 1), bool)         # the last column is for the padding
    ids = np.full((n_q, beam), -1)
    ids[:, 0] = entry
    d = _distances(x, norms, q, ids)
    done = ids < 0
    seen[:, entry] = True
    while True:
        todo = np.where(done, np.inf, d)
        pick = np.argpartition(todo, STEP - 1, 1)[:, :STEP] if beam > STEP else np.tile(np.arange(beam), (n_q, 1))
        live = np.isfinite(todo[rows, pick])
        if not live.any():
            return ids, d
        done[rows, pick] = True
        near = np.where(live[:, :, None], graph[ids[rows, pick]], -1).reshape(n_q, -1)
        near[seen[rows, near]] = -1
        # one row may meet a node by two of its picks
        near.sort(1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[rows, near] = True
        seen[:, -1] = False
        near_d = _distances(x, norms, q, near)
        all_ids, all_d = np.concatenate([ids, near], 1), np.concatenate([d, near_d], 1)
        all_done = np.concatenate([done, near < 0], 1)
        keep = np.argpartition(all_d, beam - 1, 1)[:, :beam]
        keep = np.take_along_axis(keep, np.argsort(all_d[rows, keep], 1, kind="stable"), 1)
        ids, d, done = all_ids[rows, keep], all_d[rows, keep], all_done[rows, keep]


def robust_prune(x, norms, points: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` diverse neighbours for each point out of its row of candidates (-1 pads)."""
    rows = np.arange(len(points))[:, None]
    candidates = np.sort(candidates, 1)
    bad = (candidates < 0) | (candidates == points[:, None])
    bad[:, 1:] |= candidates[:, 1:] == candidates[:, :-1]
    v = x[candidates]
    p = x[points]
    d = np.maximum(norms[points][:, None] + norms[candidates] - 2 * np.einsum("bkd,bd->bk", v, p), 0)
    d = np.where(bad, np.inf, d)
    order = np.argsort(d, 1, kind="stable")
    candidates, d, v = candidates[rows, order], d[rows, order], v[rows, order]
    between = norms[candidates][:, :, None] + norms[candidates][:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
    out = np.full((len(points), degree), -1)
    alive = np.isfinite(d)
    for k in range(degree):
        has = alive.any(1)
        if not has.any():
            break
        best = alive.argmax(1)
        out[has, k] = candidates[has, best[has]]
        alive &= ~((ALPHA * ALPHA * between[rows[:, 0], best] <= d) & has[:, None])
        alive[rows[:, 0], best] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> tuple[np.ndarray, int]:
    """``(neighbours, entry)`` of a graph over the rows of ``x`` by batch insertion."""
    n = len(x)
    norms = (x * x).sum(1)
    entry = int(np.argmin(norms - 2 * x @ x.mean(0))) if n else 0
    graph = np.full((n + 1, degree), -1)
    graph_size = np.zeros(n, np.int64)
    order = np.random.default_rng(7).permutation(n)
    order = np.r_[entry, order[order != entry]] if n else order
    at = 1
    while at < n:
        batch = order[at:at + min(BATCH, max(1, at))]
        found, _ = beam_search(x, norms, graph, entry, x[batch], min(beam, n))
        # points of one batch also see each other's order: a few random fellows
        graph[batch] = robust_prune(x, norms, batch, found, degree)
        graph_size[batch] = (graph[batch] >= 0).sum(1)
        # the edges back, several new ones per node at once
        src = np.repeat(batch, degree)
        dst = graph[batch].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
        place = np.arange(len(dst)) - np.repeat(first, count)
        fits = graph_size[dst] + place < degree
        graph[dst[fits], (graph_size[dst] + place)[fits]] = src[fits]
        graph_size[nodes] = np.minimum(graph_size[nodes] + count, degree)
        over = np.unique(dst[~fits])
        if len(over):
            extra = np.searchsorted(nodes, over)
            width = int(count[extra].max())
            more = np.full((len(over), width), -1)
            row = np.searchsorted(over, dst)
            mine = (row < len(over)) & (over[np.minimum(row, len(over) - 1)] == dst)
            more[row[mine], place[mine]] = src[mine]
            for lo in range(0, len(over), BATCH):
                part = slice(lo, lo + BATCH)
                graph[over[part]] = robust_prune(x, norms, over[part], np.concatenate([graph[over[part]], more[part]], 1), degree)
            graph_size[over] = (graph[over] >= 0).sum(1)
        at += len(batch)
    return graph, entry


def lift(v: np.ndarray) -> np.ndarray:
    """Vectors, scaled by a power of two, with a coordinate more that gives all of them the same norm (float32)."""
    v = v.astype(np.float64)
    v = np.ldexp(v, -np.frexp(np.abs(v).max(initial=0.0))[1])
    norms = (v * v).sum(1)
    return np.c_[v, np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0))].astype(np.float32)


def inner_products(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The product of each row with ``q``; infinite only if it is itself beyond the range of doubles, never nan."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = v @ q
        for i in np.flatnonzero(~np.isfinite(out)):
            a, b = (np.frexp(np.abs(x).max())[1] for x in (v[i], q))
            # rounded products, exactly summed: a fused multiply-add leaves a rest where products cancel
            out[i] = np.ldexp(math.fsum(np.ldexp(v[i], -a) * np.ldexp(q, -b)), a + b)
    return out


def _pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def prepare(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(id, dim, k1, k2, class, v)`` of the vectors that take part; equal vectors have equal keys.

    Norms of a class are within a factor of 16; 1 and 16 are in the middle of theirs.
    """
    def run(batches):
        for batch in batches:
            ids = column(batch, "id")
            lists = column(batch, "e").cast(pa.list_(pa.float64()))
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            flat = lists.flatten()
            values = flat.to_numpy(zero_copy_only=False) + 0.0          # null becomes nan, -0.0 becomes 0.0
            row = np.repeat(np.arange(len(size)), size)
            bad = np.bincount(row, ~np.isfinite(values), len(size)) > 0
            zero = np.bincount(row, values != 0, len(size)) == 0
            keep = ~bad & ~zero & ids.is_valid().to_numpy(zero_copy_only=False)
            values = values[keep[row]]
            size = size[keep]
            raw = np.ascontiguousarray(values).view(np.uint64)
            ends = np.cumsum(size)
            place = np.arange(len(values)) - np.repeat(ends - size, size)
            row = np.repeat(np.arange(len(size)), size)
            top = np.zeros(len(size))
            np.maximum.at(top, row, np.abs(values))
            exponent = np.frexp(top)[1]
            square = np.bincount(row, np.ldexp(values, -exponent[row]) ** 2, len(size))
            norm_class = np.floor((exponent + np.log2(square) / 2 + CLASS_BITS / 2) / CLASS_BITS)
            keys = []
            for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                c = np.r_[np.zeros(1, np.uint64), np.cumsum(mix(raw ^ np.uint64(base)) * powers(base, int(size.max(initial=1)))[place])]
                keys.append(pa.array(mix(c[ends] - c[ends - size]).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [ids.filter(pa.array(keep)), pa.array(size.astype(np.int32)), *keys, pa.array(norm_class.astype(np.int32)),
                 binary(values.view(np.uint8), size * 8)],
                names=["id", "dim", "k1", "k2", "class", "v"])
    picked = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("e"))
    return picked.mapInArrow(run, "id long, dim int, k1 long, k2 long, class int, v binary")


def _matrix(binary_column, dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(b.as_buffer(), np.float64, dim) for b in binary_column])


class Index:
    """A shard's graph, unpacked, and its search."""

    def __init__(self, packed: bytes):
        with np.load(io.BytesIO(packed)) as z:
            self.v, self.graph, self.entry = z["v"], z["graph"].astype(np.int64), int(z["entry"])
            self.ids, self.ends = z["ids"], z["ends"]
        x = lift(self.v)
        self.norms = np.zeros(len(x) + 1, np.float32)         # equal for all rows, so the products alone rank
        self.x = np.r_[x, np.zeros((1, x.shape[1]), np.float32)]

    def search(self, own: np.ndarray, vectors, k: int):
        """Record batches ``query_id, vec_id, score`` of the nearest found for a batch of queries."""
        v, ids, ends = self.v, self.ids, self.ends
        q = _matrix(vectors, v.shape[1])
        for lo in range(0, len(q), BATCH):
            part = q[lo:lo + BATCH]
            part = np.ldexp(part, -np.frexp(np.abs(part).max(1, keepdims=True))[1])
            part = np.c_[part, np.zeros(len(part))].astype(np.float32)
            found, _ = beam_search(self.x, self.norms, self.graph, self.entry, part, min(max(SEARCH_BEAM, 2 * k), len(v)))
            out = []
            for i, row in enumerate(found):
                row = row[row >= 0]
                score = inner_products(v[row], q[lo + i])
                best = np.lexsort((ids[ends[row]], -score))[:k + 1]
                hits = [(-score[b], j) for b in best for j in ids[ends[row[b]]:ends[row[b] + 1]] if j != own[lo + i]]
                out += [(own[lo + i], j, -s) for s, j in sorted(hits)[:k]]
            if out:
                a, b, c = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())],
                                                 names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", query_every: int = 20, k: int = 20,
            shard: int = SHARD) -> DataFrame:
    """The ``k`` nearest of every query: query_id, rank (from 1), vec_id, score (inner product, double).

    Queries are the rows whose id is divisible by ``query_every``; candidates
    are all rows of the same dimension but the query's own, ties go to the
    smaller id.  Null, zero and non-finite vectors, vectors with a null in
    them and rows without id take no part; repeated rows count once.  A query
    with fewer than ``k`` candidates gets them all, one with none no row.
    A product beyond the range of doubles is an infinite score.
    """
    base = materialize(prepare(vectors, vec_id, embedding), "ann-vectors")
    key = ["dim", "k1", "k2"]
    place = F.dense_rank().over(Window.partitionBy(*key).orderBy("id"))
    nodes = (base.withColumn("place", place).where(F.col("place") <= k + 1).groupBy(*key)
             .agg(F.array_sort(F.collect_set("id")).alias("ids"), F.first("class").alias("class"), F.first("v").alias("v")))
    nodes = materialize(nodes, "ann-nodes")
    shards = nodes.groupBy("dim", "class").agg(F.ceil(F.count("*") / shard).alias("shards"))
    shards = bounded(materialize(shards, "ann-shards"))
    dealt = nodes.join(shards, ["dim", "class"]).withColumn("shard", F.pmod(F.xxhash64("k1", "k2"), F.col("shards"))).withColumn(
        "task", F.xxhash64("dim", "class", "shard"))

    def build(batches):
        for t in by_group(batches, "task"):
            dim = t.column("dim")[0].as_py()
            order = pc.sort_indices(t, sort_keys=[("k1", "ascending"), ("k2", "ascending")])
            t = t.take(order)
            v = _matrix(t.column("v"), dim)
            ids = t.column("ids").to_pylist()
            x = lift(v)
            graph, entry = build_graph(x)
            index = _pack(v=v, graph=graph.astype(np.int32), entry=np.array(entry), ids=np.array([i for many in ids for i in many]),
                          ends=np.r_[0, np.cumsum([len(many) for many in ids])])
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([t.column("class")[0].as_py()], pa.int32()),
                 pa.array([t.column("shard")[0].as_py()], pa.int64()), pa.array([index], pa.binary())],
                names=["dim", "class", "shard", "index"])
    graphs = (dealt.select("task", "dim", "class", "shard", "k1", "k2", "ids", "v").repartition("task").sortWithinPartitions("task")
              .mapInArrow(build, "dim int, class int, shard long, index binary"))
    graphs = materialize(graphs, "ann-graphs")

    # Every query goes to every shard.  A shard's index is read by one task, or by as many as there are
    # cores to spare where shards are few, so it is copied a bounded number of times whatever the queries.
    asked = base.where(F.col("id") % query_every == 0).select("id", "dim", "v").dropDuplicates(["id", "v"])
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    asked_of = asked.groupBy("dim").agg(F.count("*").alias("asked"))
    parts = shards.groupBy("dim").agg(F.sum("shards").alias("all")).join(asked_of, "dim").select(
        "dim", F.least(F.ceil(F.lit(cores) / F.col("all")), F.ceil(F.col("asked") / BATCH)).alias("parts"))
    places = bounded(materialize(shards.join(parts, "dim"), "ann-places"))
    task = F.xxhash64("dim", "class", "shard", "part").alias("task")
    none = F.lit(None)
    asked = asked.join(places, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    questions = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).select(
        task, F.lit(1).alias("kind"), "id", "dim", "v", none.cast("binary").alias("index"))
    indexes = graphs.join(places, ["dim", "class"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        task, F.lit(0).alias("kind"), none.cast("long").alias("id"), "dim", none.cast("binary").alias("v"), "index")

    def search(batches):
        index = task = None
        for batch in batches:
            tasks, kinds = column(batch, "task").to_numpy(), column(batch, "kind").to_numpy()
            cuts = np.flatnonzero((tasks[1:] != tasks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(tasks)], strict=True):
                if lo == hi:
                    continue
                if kinds[lo] == 0:              # a task's index comes first, its queries after it, in any number of batches
                    index, task = Index(column(batch, "index")[int(lo)].as_py()), tasks[lo]
                elif task == tasks[lo]:
                    own = column(batch, "id").to_numpy(zero_copy_only=False)[lo:hi].astype(np.int64)
                    yield from index.search(own, column(batch, "v").slice(lo, hi - lo), k)
    tasks = questions.union(indexes).repartition("task").sortWithinPartitions("task", "kind")
    found = tasks.mapInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
