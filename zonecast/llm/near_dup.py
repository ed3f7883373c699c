"""Near-duplicate documents by SetSketch registers, banding and verification.

Every distinct shingle of a document throws exponentially distributed values
at the registers; a register keeps the smallest, truncated to an integer on a
logarithmic scale.  Registers merge by maximum and two documents agree in a
register about as often as their sets overlap.  Documents that agree in all
registers of some band are candidates.  Candidates are screened by the
maximum-likelihood estimate of their similarity from the joint order of all
registers and then compared on their full shingle sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.components import components
from zonecast.llm.groups import binary, by_group, column
from zonecast.llm.shared import bounded, materialize
from zonecast.llm.textbytes import (MULTIPLIER, NOT_SPACE, gram_hashes, mix, slices, stream,
                                    word_hashes, words)

REGISTERS = 256              # a power of two: odd strides visit every register once
MISS = 5e-6                  # a pair at the threshold shares no band at most this often
SCALE = 20.0
BASE = 1.05
TOP = (1 << 16) - 2
BLOCK = 1000                 # documents compared at once in one task
PIVOTS = 64                  # documents of a large cluster that every block of it meets


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text as ``(row, hash)``, sorted by both.

    A text with fewer than ``k`` words, but some, has one shingle: all of them.
    """
    n_rows = len(offsets) - 1
    start, end, row = words(data, offsets, NOT_SPACE)
    word = word_hashes(data, start, end)
    count = np.bincount(row, minlength=n_rows)
    last = np.cumsum(count)
    gram = gram_hashes(word, k)
    at = np.arange(len(gram))
    keep = at + k <= last[row[:len(gram)]]
    rows, values = [row[:len(gram)][keep]], [gram[keep]]
    for size in range(1, k):
        short = np.flatnonzero(count == size)
        if len(short):
            rows.append(short)
            values.append(mix(gram_hashes(word, size)[last[short] - size] ^ np.uint64(size)))
    rows, values = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def registers(rows: np.ndarray, values: np.ndarray, n_rows: int, m: int = REGISTERS) -> np.ndarray:
    """SetSketch registers of every row: an ``n_rows x m`` array of uint16 (0 for an empty set).

    The points of one element ascend and visit the registers in a random
    order without repeats, so an element stops as soon as its next point is
    above all of its row's current minima.
    """
    low = np.full(n_rows * m, np.inf)
    row, h, x = rows.astype(np.int64), values, np.zeros(len(values))
    at = (stream(h, 0) & np.uint64(m - 1)).astype(np.int64)
    stride = ((stream(h, 1) & np.uint64(m - 1)) | np.uint64(1)).astype(np.int64)
    for j in range(m):
        if not len(h):
            break
        u = ((stream(h, j + 2) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        x = x - np.log(u) / (SCALE * (m - j))
        np.minimum.at(low, row * m + at, x)
        most = low.reshape(n_rows, m).max(1)
        keep = x < most[row]
        row, h, x, stride = row[keep], h[keep], x[keep], stride[keep]
        at = (at[keep] + stride) & (m - 1)
    with np.errstate(divide="ignore"):
        out = np.floor(1.0 - np.log(low) / math.log(BASE))
    return np.clip(out, 0, TOP).astype(np.uint16).reshape(n_rows, m)


def band_rows(threshold: int, m: int = REGISTERS) -> int:
    """The most registers per band with which a pair at ``threshold`` per cent is missed at most ``MISS`` of the time."""
    return max([1, *(r for r in range(1, m) if (1 - (threshold / 100) ** r) ** (m // r) <= MISS)])


def band_keys(regs: np.ndarray, per_band: int) -> np.ndarray:
    """One 64-bit key per row and band."""
    bands = regs.shape[1] // per_band
    out = np.empty((len(regs), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(regs), b + 1, np.uint64)
        for r in range(per_band):
            key = (key + regs[:, b * per_band + r].astype(np.uint64)) * MULTIPLIER
            key ^= key >> np.uint64(31)
        out[:, b] = mix(key)
    return out


def _bands(docs: DataFrame, per_band: int, *, carry: str = "") -> DataFrame:
    """``(key, cid)`` for every band of the ``regs`` of each document, with the columns that ``carry`` names."""
    extra = [c.split()[0] for c in carry.split(", ")] if carry else []

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                regs = np.stack([np.frombuffer(b.as_buffer(), np.uint16) for b in column(batch, "regs")])
                keys = band_keys(regs, per_band)
                row = pa.array(np.repeat(np.arange(len(regs)), keys.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), *(column(batch, c).take(row) for c in ["cid", *extra])],
                    names=["key", "cid", *extra])
    return docs.select("cid", "regs", *extra).mapInArrow(run, "key long, cid long" + (", " + carry if carry else ""))


_GRID = (np.arange(128) + 0.5) / 128


def estimate(a: np.ndarray, n_a: int, others: np.ndarray, n_others: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of one sketch with each of several, on a grid.

    The counts of registers in which either side is larger, and in which both
    agree, follow a trinomial law whose probabilities depend on the two set
    sizes (known here) and the similarity.
    """
    more = (a[None, :] > others).sum(1)[:, None]
    less = (a[None, :] < others).sum(1)[:, None]
    same = len(a) - more - less
    u = (n_a / (n_a + n_others))[:, None]
    v = 1.0 - u
    j = _GRID[None, :] * np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)
    p_more, p_less = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
    value = more * np.log(p_more) + less * np.log(p_less) + same * np.log(np.maximum(1 - p_more - p_less, 1e-12))
    return np.take_along_axis(j, value.argmax(1)[:, None], 1)[:, 0]


def links(ids: np.ndarray, sets: list[np.ndarray], regs: np.ndarray, query: np.ndarray, threshold: int,
          label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """``(smallest id, id)`` for every document that verified links connect with a smaller one here.

    Only the documents marked in ``query`` look for partners; two that are
    already known to be connected (equal labels) need no further look.  A
    link holds if ``100 * intersection >= threshold * union``.
    """
    n = len(ids)
    size = np.array([len(s) for s in sets], np.int64)
    starts = np.r_[0, np.cumsum(size)[:-1]]
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    flag = np.zeros(int(code.max()) + 1 if len(code) else 1, bool)
    group = np.unique(label, return_inverse=True)[1].copy() if label is not None else np.arange(n)
    start = group.copy()
    sure = threshold / 100
    margin = sure - 6 * math.sqrt(sure * (1 - sure) / regs.shape[1])
    for x in np.flatnonzero(query):
        other = (group != group[x]) & (100 * np.minimum(size, size[x]) >= threshold * np.maximum(size, size[x]))
        y = np.flatnonzero(other)
        if len(y):
            y = y[estimate(regs[x], size[x], regs[y], size[y]) >= margin]
        if not len(y):
            continue
        mine = code[starts[x]:starts[x] + size[x]]
        flag[mine] = True
        where = np.repeat(starts[y] - np.r_[0, np.cumsum(size[y])[:-1]], size[y]) + np.arange(size[y].sum())
        common = np.add.reduceat(flag[code[where]], np.r_[0, np.cumsum(size[y])[:-1]], dtype=np.int64)
        flag[mine] = False
        for z in y[100 * common >= threshold * (size[x] + size[y] - common)]:
            if group[z] != group[x]:
                group[group == group[z]] = group[x]
    # ids ascend, so the first of a group is its smallest; one edge for each earlier group that it took in
    _, first, group = np.unique(group, return_index=True, return_inverse=True)
    _, lead, start = np.unique(start, return_index=True, return_inverse=True)
    return [(int(ids[first[group[x]]]), int(ids[x])) for x in lead if first[group[x]] != x]


def _verify(tasks: DataFrame, threshold: int, labelled: bool) -> DataFrame:
    """Links found within each task: rows (task, cid, query, regs, shingles[, label])."""
    def run(batches):
        for t in by_group(batches, "task"):
            t = t.sort_by([("cid", "ascending"), ("query", "descending")])
            ids, first = np.unique(t.column("cid").to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            t = t.take(pa.array(first))
            sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in t.column("shingles")]
            regs = np.stack([np.frombuffer(b.as_buffer(), np.uint16) for b in t.column("regs")])
            found = links(ids, sets, regs, t.column("query").to_numpy(), threshold,
                          t.column("label").to_numpy() if labelled else None)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    cols = ["task", "cid", "query", "regs", "shingles"] + (["label"] if labelled else [])
    return tasks.select(*cols).repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def _large_clusters(large: DataFrame, per_band: int, threshold: int) -> DataFrame:
    """``(node, label)`` of the documents of clusters of several blocks.

    Each block is searched on its own together with some pivots of the whole
    cluster, so that its blocks join up without meeting each other.  Documents
    that are then outside the cluster's main component still have to meet the
    others: those of their buckets, whose keys come from the registers again, or
    the whole cluster where that takes fewer comparisons.  A cluster that chance collisions hold
    together has many small buckets, copies of one text share nearly all.
    """
    task = F.xxhash64("cluster", "block").alias("task")
    own = large.select(task, "cid", F.lit(True).alias("query"), "regs", "shingles")
    place = F.row_number().over(Window.partitionBy("cluster").orderBy(F.xxhash64("cid"), "cid"))
    few = large.select("cluster", "cid").withColumn("place", place).where(F.col("place") <= PIVOTS).select("cid")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pivots = large.join(few, "cid").withColumn("block", every).select(task, "cid", F.lit(True).alias("query"), "regs", "shingles")
    found = materialize(_verify(own.union(pivots), threshold, False), "sketch-links")

    known = components(found)
    split = large.join(known, large["cid"] == known["node"], "left").drop("node")
    split = split.withColumn("label", F.coalesce("label", "cid"))
    per = split.groupBy("cluster", "label").agg(F.count("*").alias("n"))
    main = per.groupBy("cluster").agg(F.max(F.struct("n", "label"))["label"].alias("main"), F.count("*").alias("parts"))
    split = materialize(split.join(main.where("parts > 1"), "cluster").withColumn("query", F.col("label") != F.col("main")), "sketch-split")
    if split.where("query").isEmpty():
        return known

    # Comparisons bucket by bucket, where a bucket of one label has none, against those of the whole cluster.
    asks = F.count_if("query")
    placed = materialize(_bands(split, per_band, carry="cluster long, label long, query boolean"), "sketch-placed")
    buckets = materialize(
        placed.groupBy("cluster", "key").agg(F.count("*").alias("size"), asks.alias("asks"), F.min("label").alias("l0"), F.max("label").alias("l1"))
        .where("asks > 0 and l0 < l1").select("cluster", "key", "size", "asks"), "sketch-asked")
    whole = split.groupBy("cluster").agg((asks.cast("double") * F.count("*")).alias("whole"))
    apart = buckets.groupBy("cluster").agg(F.sum(F.col("asks").cast("double") * F.col("size")).alias("apart"))
    choice = materialize(whole.join(apart, "cluster").select("cluster", (F.col("apart") < F.col("whole")).alias("by_bucket")), "sketch-choice")

    cols = ["group", "blocks", "block", "cid", "query", "regs", "shingles", "label"]
    by_cluster = split.join(choice.where("not by_bucket").select("cluster"), "cluster").withColumn("group", F.col("cluster"))
    kept = buckets.join(choice.where("by_bucket").select("cluster"), "cluster").select(
        "cluster", "key", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    members = placed.join(kept, ["cluster", "key"]).select(
        F.col("key").alias("group"), "cid", "blocks", F.pmod(F.xxhash64("cid"), F.col("blocks")).alias("block"))
    by_bucket = members.join(split.drop("blocks", "block"), "cid")
    search = by_cluster.select(*cols).union(by_bucket.select(*cols))
    return components(found.union(_ask(search, threshold)))


def _ask(search: DataFrame, threshold: int) -> DataFrame:
    """Links of the documents marked in ``query`` with those of all blocks of their group."""
    groups = search.where("query").select("group", F.col("block").alias("from")).distinct()
    cols = ["task", "cid", "query", "regs", "shingles", "label"]
    targets = search.join(groups, "group").withColumn("task", F.xxhash64("group", "block", "from")).withColumn("query", F.lit(False))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    queries = search.where("query").withColumn("to", every).withColumn("task", F.xxhash64("group", "to", "block"))
    return _verify(queries.select(*cols).union(targets.select(*cols)), threshold, True)


def _clustered(docs: DataFrame, doc_id: str, text: str, shingle_words: int, threshold: int, m: int) -> DataFrame:
    """Per row: doc, th (hash of the text), n, label (equal for connected documents, null without shingles), component_id."""
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    source = source.withColumn("th", F.xxhash64("text"))

    def scan(batches):
        for batch in batches:
            ids, th = column(batch, "doc"), column(batch, "th")
            for lo, hi, data, offsets in slices(column(batch, "text")):
                n = hi - lo
                row, h = shingles(data, offsets, shingle_words)
                size = np.bincount(row, minlength=n)
                digest = []
                for j in (400, 401):
                    c = np.r_[np.zeros(1, np.uint64), np.cumsum(stream(h, j))]
                    ends = np.cumsum(size)
                    total = c[ends] - c[ends - size]
                    digest.append(pa.array(total.view(np.int64)))
                regs = registers(row, h, n, m)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, n), th.slice(lo, n), pa.array(size.astype(np.int64)), *digest,
                     binary(regs.reshape(-1).view(np.uint8), np.full(n, regs.shape[1] * 2))],
                    names=["doc", "th", "n", "d1", "d2", "regs"])
    scanned = source.mapInArrow(scan, f"doc {kind}, th long, n long, d1 long, d2 long, regs binary")
    base = materialize(scanned.withColumn("row", F.monotonically_increasing_id()), "sketch-docs")

    keys = ["n", "d1", "d2"]
    classes = materialize(base.where("n > 0").groupBy(*keys).agg(F.min("row").alias("cid"), F.min("doc").alias("doc0")),
                          "sketch-classes")
    reps = base.select("row", "doc", "th", "n", "regs").join(classes.select(F.col("cid").alias("row")), "row")
    reps = materialize(reps.withColumnRenamed("row", "cid"), "sketch-reps")

    per_band = band_rows(threshold, m)
    banded = materialize(_bands(reps, per_band), "sketch-bands")
    shared = banded.groupBy("key").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a < z").select("key", "a")
    shared = materialize(shared, "sketch-buckets")
    star = banded.join(bounded(shared), "key").where("cid <> a").select("a", F.col("cid").alias("b"))
    clusters = components(star).withColumnsRenamed({"node": "cid", "label": "cluster"})

    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("members"))
    wanted = clusters.join(sizes, "cluster").join(reps, "cid").withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    wanted = wanted.select("cid", "cluster", "members", "blocks", "block", "regs", F.col("doc").alias("w_doc"), F.col("th").alias("w_th"))

    def sets(batches):
        for batch in batches:
            names = [f.name for f in batch.schema if f.name != "text"]
            for lo, hi, data, offsets in slices(column(batch, "text")):
                row, h = shingles(data, offsets, shingle_words)
                size = np.bincount(row, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [column(batch, c).slice(lo, hi - lo) for c in names] + [binary(h.view(np.uint8), size * 8)],
                    names=[*names, "shingles"])
    found = source.join(wanted, (source["th"] == wanted["w_th"]) & source["doc"].eqNullSafe(wanted["w_doc"]))
    members = materialize(
        found.select("cid", "cluster", "members", "blocks", "block", "regs", "text")
        .mapInArrow(sets, "cid long, cluster long, members long, blocks long, block long, regs binary, shingles binary"),
        "sketch-members")

    # A cluster of one block is settled in its task.
    alone = members.where("blocks = 1").select(F.col("cluster").alias("task"), "cid", F.lit(True).alias("query"), "regs", "shingles")
    label = materialize(_verify(alone, threshold, False), "sketch-links").select(F.col("b").alias("node"), F.col("a").alias("label"))
    large = members.where("blocks > 1")
    if not large.isEmpty():
        label = label.union(_large_clusters(large, per_band, threshold))
    labelled = classes.join(label, classes["cid"] == label["node"], "left").withColumn("label", F.coalesce("label", "cid"))
    smallest = labelled.groupBy("label").agg(F.min("doc0").alias("component_id"))
    by_class = labelled.join(smallest, "label").select(*keys, "label", "component_id")
    out = base.select("doc", "th", *keys).join(by_class, keys, "left")
    own = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component_id"))
    return out.select("doc", "th", "n", "label", own.alias("component_id"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 5,
                    threshold: int = 80, m: int = REGISTERS) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id, kept.

    Words are runs of anything but ASCII white space, A-Z lower-cased.  Two
    documents are linked if their sets of ``shingle_words``-word shingles have
    a Jaccard similarity of at least ``threshold`` per cent;
    ``component_id`` is the smallest doc_id that links reach.

    ``m``, a power of two, is the number of registers: the more, the longer
    the bands can be, and the fewer documents that share little become
    candidates.  Identical sets form a class that is represented once.  Null and empty
    texts (and those of white space) have no shingles and are linked with
    nothing.  Rows with a repeated id each count as a document.  A null id is
    never the smallest where another exists; ``kept`` compares null-safely.
    Other columns are ignored; an empty table gives an empty result.
    """
    out = _clustered(docs, doc_id, text, shingle_words, threshold, m)
    return out.select(F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), "component_id",
                      F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 5,
                         threshold: int = 80, m: int = REGISTERS) -> DataFrame:
    """``docs`` with one row left of every component of :func:`near_duplicates`.

    The row with the smallest id stays (null last; then by a hash of the
    text).  Rows without shingles all stay; of rows equal in id and text one
    stays.
    """
    rows = materialize(_clustered(docs, doc_id, text, shingle_words, threshold, m).where("n > 0").select("doc", "th", "label"), "sketch-rows")
    place = F.struct(F.col("doc").isNull().alias("a"), F.col("doc").alias("d"), F.col("th").alias("t"))
    first = rows.groupBy("label").agg(F.min(place).alias("first"))
    other = ~(F.col("doc").eqNullSafe(F.col("first.d")) & (F.col("th") == F.col("first.t")))
    gone = rows.join(first, "label").where(other).select(F.col("doc").alias("g_doc"), F.col("th").alias("g_th")).distinct()
    gone = bounded(materialize(gone, "sketch-gone"))
    th = F.xxhash64(F.col(text).cast("string"))
    left = docs.join(gone, (th == gone["g_th"]) & docs[doc_id].eqNullSafe(gone["g_doc"]), "left_anti")
    twice = materialize(rows.groupBy("doc", "th").count().where("count > 1").select(F.col("doc").alias("t_doc"), F.col("th").alias("t_th")), "sketch-twice")
    if twice.isEmpty():
        return left
    twice = bounded(twice)
    same = (th == twice["t_th"]) & left[doc_id].eqNullSafe(twice["t_doc"])
    return left.join(twice, same, "left_anti").union(left.join(twice, same, "left_semi").dropDuplicates([doc_id, text]))
