"""Hard negatives by exact integer inner products on tiles.

Vectors become integers, anchors are dealt into blocks and all vectors into
tiles.  A task multiplies one block with one tile by Strassen's recursion
(seven products of half the size, exact additions, zero padding where a side
is odd) and keeps, per anchor, only the best of the tile.  These bounded heaps
merge by one ranking: first the positives of every anchor; then, with their
scores known, the best of each positive's score window.

The work is anchors times rows, the stated query set against all rows, in
blocks; what moves is every vector once for each block of anchors and every anchor
once for each tile, both sized by their number of components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.groups import binary, by_group, column
from zonecast.llm.shared import bounded, materialize

CELLS = 1 << 19                 # components of a block of anchors, and of a tile
ROWS, COLUMNS = 256, 8192       # scores held at once
LEAF = 16
_LIMIT = 1 << 63


def _even(a: np.ndarray) -> np.ndarray:
    """Zero-padded to even sides."""
    m, n = a.shape
    if m % 2 == 0 and n % 2 == 0:
        return a
    out = np.zeros((m + m % 2, n + n % 2), a.dtype)
    out[:m, :n] = a
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` for integer matrices by seven half-sized products.

    Exact: additions modulo 2**64 lose nothing where the product itself fits
    64 bits, and arrays of Python integers have no bound at all.
    """
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        out = np.zeros((m, n), a.dtype)
        for j in range(k):
            out += a[:, j:j + 1] * b[j:j + 1]
        return out
    a, b = _even(a), _even(b)
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * j), a.dtype)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def integers(vectors: DataFrame, scale: float, vec_id: str, embedding: str, label: str) -> DataFrame:
    """``id, label, dim, v``: floor(scale * x) of every component, as whole doubles; rows that take no part are left out."""
    def run(batches):
        for batch in batches:
            e = column(batch, "e")
            size = np.diff(e.offsets.to_numpy())
            size[e.is_null().to_numpy(zero_copy_only=False)] = 0
            flat = e.flatten()
            x = np.floor(scale * flat.to_numpy(zero_copy_only=False).astype(np.float64))
            row = np.repeat(np.arange(len(e)), size)
            keep = size > 0
            keep[row[~np.isfinite(x)]] = False
            x, mask = x[keep[row]], pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id").filter(mask), column(batch, "label").filter(mask), pa.array(size[keep].astype(np.int32)),
                 binary(x.view(np.uint8), size[keep].astype(np.int64) * 8)], names=["id", "label", "dim", "v"])
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                          F.col(embedding).cast("array<double>").alias("e"))
    return rows.where("id is not null and label is not null").mapInArrow(run, "id long, label long, dim int, v binary")


def _matrix(binaries, dim: int) -> np.ndarray:
    """Whole doubles as int64, or as Python integers where they are beyond it."""
    x = np.frombuffer(b"".join(b.as_py() for b in binaries), np.float64).reshape(-1, dim)
    return x.astype(np.int64) if np.abs(x).max(initial=0) < 2.0**62 else np.array([[int(v) for v in r] for r in x], object).reshape(-1, dim)


def _fits(a: np.ndarray, b: np.ndarray, factor: int) -> bool:
    """Whether ``factor`` times any inner product of rows is sure to fit 64 bits."""
    return int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1] * factor < _LIMIT


def _best(score: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the places of the ``k`` largest allowed scores, ties to the smaller id."""
    out = []
    for s, ok in zip(score, allowed, strict=True):
        at = np.flatnonzero(ok)
        if len(at) > k and s.dtype != object:
            bar = np.partition(s[at], len(at) - k)[len(at) - k]
            at = at[s[at] >= bar]
        if s.dtype == object:
            at = np.array(sorted(at, key=lambda j: (-s[j], ids[j])), np.int64)
        else:
            at = at[np.lexsort((ids[at], -s[at]))]
        out.append(at[:k])
    return out


def _pairs(anchors: DataFrame, rows: DataFrame, tiles: DataFrame, carry: list[str]) -> DataFrame:
    """Anchor blocks and tiles dealt to one task a pair: part 0 the anchors, part 1 the tile's rows."""
    task = F.xxhash64("dim", "tile", "block").alias("task")
    sides = anchors.join(tiles, "dim").withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    sides = sides.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    left = sides.select(task, F.lit(0).alias("part"), "id", "label", "dim", "v", *carry)
    sides = rows.join(tiles, "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sides = sides.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")))
    kinds = dict(anchors.dtypes)
    right = sides.select(task, F.lit(1).alias("part"), "id", "label", "dim", "v", *[F.lit(None).cast(kinds[c]).alias(c) for c in carry])
    return left.union(right).repartition("task").sortWithinPartitions("task", "part", "id")


def _scores(batches, factor: int, rows: int, columns: int):
    """``(anchors, tile ids, tile labels, scores)`` for pieces of ``rows`` by ``columns`` of every task's product."""
    for t in by_group(batches, "task"):
        part = t.column("part").to_numpy()
        n = int((part == 0).sum())
        if n == 0 or n == len(part):
            continue
        dim = t.column("dim")[0].as_py()
        a, c = _matrix(t.column("v").slice(0, n), dim), _matrix(t.column("v").slice(n), dim)
        ids, labels = t.column("id").to_numpy()[n:], t.column("label").to_numpy()[n:]
        anchors = t.slice(0, n)
        for lo in range(0, n, rows):
            for at in range(0, len(c), columns):
                x, y = a[lo:lo + rows], c[at:at + columns]
                if a.dtype == object or c.dtype == object or not _fits(x, y, factor):
                    x, y = x.astype(object), y.astype(object)
                yield anchors.slice(lo, rows), ids[at:at + columns], labels[at:at + columns], strassen(x, np.ascontiguousarray(y.T))


def _long(x) -> int:
    """The nearest 64-bit value."""
    return max(-_LIMIT, min(_LIMIT - 1, int(x)))


def sort_key(x: int) -> bytes | None:
    """Bytes that sort like the numbers, for those beyond 64 bits; None for the others."""
    if -_LIMIT <= x < _LIMIT:
        return None
    digits = abs(x).to_bytes((abs(x).bit_length() + 7) // 8)
    head = (0x8000 + len(digits) * (1 if x > 0 else -1)).to_bytes(2)
    return head + (digits if x > 0 else bytes(255 - d for d in digits))


def from_key(score: int, key: bytes | None) -> int:
    if key is None:
        return score
    digits = key[2:] if key[0] >= 0x80 else bytes(255 - d for d in key[2:])
    return int.from_bytes(digits) * (1 if key[0] >= 0x80 else -1)


def _score_columns(scores) -> list[pa.Array]:
    """64-bit scores, and the keys of those that are clipped."""
    if getattr(scores, "dtype", None) == np.int64:
        return [pa.array(scores), pa.nulls(len(scores), pa.binary())]
    exact = [int(x) for x in scores]
    return [pa.array([_long(x) for x in exact], pa.int64()), pa.array([sort_key(x) for x in exact], pa.binary())]


def mine(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", anchor_every: int = 100,
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``anchor_every``; a row's
    score is its inner product with the anchor, components being
    floor(``scale`` * x); higher scores come first, ties go to the smaller id.
    An anchor's positives are its first ``positives`` other rows of the same
    label, a positive's negatives the first ``negatives`` rows of another
    label with ``low * positive_score <= 100 * negative_score <= high * positive_score``.

    Rows without id, label or vector, with a null, a non-finite component or
    one that ``scale`` makes infinite, and empty vectors take no part.  Only
    vectors of one dimension meet.  Rows that repeat an id with the same label
    and vector count once; an id with several vectors or labels is several
    rows, none of them an "other" row to an anchor of that id.  A pair without
    negatives gives no row.  Scores beyond 64 bits are compared exactly and
    returned as the nearest 64-bit value.
    """
    base = materialize(integers(vectors, scale, vec_id, embedding, label).dropDuplicates(["id", "label", "v"]), "negatives-vectors")
    asked = base.where(F.col("id") % anchor_every == 0).withColumn("anchor", F.xxhash64("id", "label", "v"))
    sizes = base.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(F.col("id") % anchor_every == 0).alias("anchors")).where("anchors > 0")
    sizes = sizes.select("dim", F.ceil(F.col("n") * F.col("dim") / CELLS).alias("tiles"), F.ceil(F.col("anchors") * F.col("dim") / CELLS).alias("blocks"))
    sizes = bounded(materialize(sizes, "negatives-sizes"))

    piece = (ROWS, COLUMNS)

    def find_positives(batches):
        for anchors, ids, labels, score in _scores(batches, 1, *piece):
            own, kind = (anchors.column(c).to_numpy() for c in ("id", "label"))
            best = _best(score, ids, (labels == kind[:, None]) & (ids != own[:, None]), positives)
            n = [len(b) for b in best]
            at = np.concatenate(best)
            row = np.repeat(np.arange(len(best)), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors.column("anchor").to_numpy()[row]), pa.array(ids[at]), *_score_columns(score[row, at])],
                names=["anchor", "positive_id", "score", "key"])

    best_first = (F.col("score").desc(), F.col("key").desc())
    found = _pairs(asked, base, sizes, ["anchor"]).mapInArrow(find_positives, "anchor long, positive_id long, score long, key binary")
    first = F.row_number().over(Window.partitionBy("anchor").orderBy(*best_first, "positive_id"))
    found = found.withColumn("place", first).where(F.col("place") <= positives)
    windows = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score", "key"))).alias("windows"))
    windows = materialize(windows, "negatives-positives")

    def find_negatives(batches):
        for anchors, ids, labels, score in _scores(batches, 100, *piece):
            other = labels != anchors.column("label").to_numpy()[:, None]
            lists_ = anchors.column("windows").to_pylist()
            who = anchors.column("anchor").to_numpy()
            out = []
            for rank in range(positives):
                rows = np.array([i for i, w in enumerate(lists_) if len(w) > rank], np.int64)
                if not len(rows):
                    break
                p = [from_key(lists_[i][rank]["score"], lists_[i][rank]["key"]) for i in rows]
                # low * p <= 100 * s <= high * p as whole bounds on s
                bottom, top = [-(-low * x // 100) for x in p], [high * x // 100 for x in p]
                if score.dtype != object:
                    bottom, top = [_long(x) for x in bottom], [_long(x) for x in top]
                kind_of = score.dtype
                bottom, top = np.array(bottom, kind_of)[:, None], np.array(top, kind_of)[:, None]
                part = score[rows]
                inside = other[rows] & (part >= bottom).astype(bool) & (part <= top).astype(bool)
                for i, best in zip(rows, _best(part, ids, inside, negatives), strict=True):
                    w = lists_[i][rank]
                    out += [(who[i], w["place"], w["positive_id"], w["score"], ids[j], score[i, j]) for j in best]
            if out:
                *plain, scores = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, t) for c, t in zip(plain, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                     *_score_columns(np.array(scores, score.dtype))],
                    names=["anchor", "place", "positive_id", "positive_score", "negative_id", "score", "key"])
    again = asked.join(windows, "anchor")
    found = _pairs(again, base, sizes, ["anchor", "windows"]).mapInArrow(
        find_negatives, "anchor long, place int, positive_id long, positive_score long, negative_id long, score long, key binary")
    first = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*best_first, "negative_id"))
    best = found.withColumn("rank", first).where(F.col("rank") <= negatives)
    return best.join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", F.col("score").alias("negative_score"))
