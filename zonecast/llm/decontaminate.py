"""Benchmark decontamination by winnowed fingerprints.

A document and a benchmark item that share ``t`` consecutive words share a
fingerprint: of every ``w`` consecutive ``k``-word hashes both sides keep the
smallest, and ``w + k - 1 = t``.  The fingerprints of both sides are joined
and each hit is extended to its neighbours, word by word, so a hit counts
only where ``t`` words agree.  Items of fewer than ``t`` words are one window
of their own length; for each such length every run is a fingerprint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.bloom import build, contains
from zonecast.llm.groups import column
from zonecast.llm.shared import bounded, materialize
from zonecast.llm.textbytes import ALNUM, gram_hashes, mix, slices, word_hashes, words

WINDOW_WORDS = 10
GRAM_WORDS = 5
# The membership filter has a fixed size whatever the benchmark holds; a fuller
# filter only lets more rows through to the exact join.
FILTER_BITS = 1 << 23
_NOTHING = np.zeros(0, np.int64)


def _winnow(gram: np.ndarray, row: np.ndarray, word_row_end: np.ndarray, k: int, w: int) -> np.ndarray:
    """Positions kept by winnowing: the leftmost minimum of every window of ``w`` grams of one text."""
    n = len(gram) - w + 1
    if n <= 0:
        return _NOTHING
    bits = np.uint64(32)
    keyed = (gram >> bits << bits) | np.arange(len(gram), dtype=np.uint64)
    low = keyed[:n].copy()
    for j in range(1, w):
        np.minimum(low, keyed[j:j + n], out=low)
    at = np.arange(n)
    whole = at + w + k - 1 <= word_row_end[row[:n]]
    return np.unique((low[whole] & np.uint64((1 << 32) - 1)).astype(np.int64))


def _context(word: np.ndarray, at: np.ndarray, row: np.ndarray, first: np.ndarray, last: np.ndarray,
             reach: int, k: int, outside: int) -> np.ndarray:
    """Hashes of the ``reach`` words on either side of the gram, ``outside`` beyond the text."""
    step = np.r_[np.arange(-reach, 0), np.arange(k, k + reach)]
    where = at[:, None] + step[None, :]
    ok = (where >= first[row[at]][:, None]) & (where < last[row[at]][:, None])
    out = word[np.clip(where, 0, len(word) - 1)].view(np.int64)
    return np.where(ok, out, np.int64(outside))


def _fingerprints(data, offsets, lengths, window, k, whole_only, outside):
    """``(n_words by row, rows, hashes, positions, sizes, contexts)`` of one slice.

    ``lengths``: the sizes below ``window`` whose every run is kept;
    ``whole_only``: a run of such a size counts only if it is a whole text.
    """
    n_rows = len(offsets) - 1
    start, end, row = words(data, offsets, ALNUM)
    word = word_hashes(data, start, end)
    count = np.bincount(row, minlength=n_rows)
    last = np.cumsum(count)
    first = last - count
    reach = window - k
    found = []
    gram = gram_hashes(word, k)
    at = _winnow(gram, row, last, k, window - k + 1)
    if len(at):
        found.append((row[at], gram[at].view(np.int64), at - first[row[at]], np.full(len(at), k),
                      _context(word, at, row, first, last, reach, k, outside)))
    for size in lengths:
        run = gram_hashes(word, size)
        at = np.arange(len(run))
        keep = at + size <= last[row[:len(run)]]
        if whole_only:
            keep &= (count[row[:len(run)]] == size)
        at = at[keep]
        # the size is part of the hash: runs of different sizes never meet
        found.append((row[at], mix(run[at] ^ np.uint64(size)).view(np.int64), at - first[row[at]],
                      np.full(len(at), size), np.zeros((len(at), 2 * reach), np.int64)))
    return count, found


def _merge(found, width):
    if not found:
        return _NOTHING, _NOTHING, _NOTHING, _NOTHING, np.zeros((0, width), np.int64)
    rows, hashes, at, size, context = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(rows, kind="stable")
    return rows[order], hashes[order], at[order], size[order], context[order]


def _items(items: DataFrame, window: int, k: int) -> DataFrame:
    """One row per fingerprint of each (item, text) row: item, h, i_at, i_size, i_context."""
    def run(batches):
        for batch in batches:
            ids = column(batch, "item").to_pylist()
            for lo, hi, data, offsets in slices(column(batch, "text")):
                _, found = _fingerprints(data, offsets, range(1, window), window, k, True, -1)
                rows, hashes, at, size, context = _merge(found, 2 * (window - k))
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[lo + r] for r in rows], pa.string()), pa.array(hashes), pa.array(at),
                         pa.array(size.astype(np.int32)), _lists(context)],
                        names=["item", "h", "i_at", "i_size", "i_context"])
    return items.mapInArrow(run, "item string, h long, i_at long, i_size int, i_context array<long>")


def _lists(context: np.ndarray) -> pa.Array:
    n, width = context.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(context.ravel()))


def contamination(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW_WORDS,
                  gram: int = GRAM_WORDS) -> DataFrame:
    """Per document row: its id, n_words, n_hit, n_items, items (sorted ids), spans (merged word ranges), contaminated, text_hash.

    Words are runs of ASCII letters and digits and of all characters from
    U+0080, with A-Z lower-cased.  A null or empty text has no words and no
    hits; an empty benchmark hits nothing.  Repeated rows and null ids each
    give their own row; items that share an id count once, an item without id
    is named ``null``.  Other columns are ignored.
    """
    spark = docs.sparkSession
    reach = window - gram
    # items with one text are one class, named by one of its ids
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"),
                         F.col(item_text).cast("string").alias("text")).where(F.col("text").isNotNull())
    classes = materialize(named.groupBy("text").agg(F.collect_set("id").alias("ids"))
                          .withColumn("item", F.monotonically_increasing_id().cast("string")), "winnow-classes")
    prints = materialize(_items(classes.select("item", "text"), window, gram), "winnow-items")
    lengths = sorted(r[0] for r in prints.where(F.size("i_context") > 0).where(
        (F.col("i_size") != gram) | (F.element_at("i_context", 1) == 0)).select("i_size").distinct().collect())
    bits = spark.sparkContext.broadcast(build(prints, "h", FILTER_BITS))       # FILTER_BITS / 8 bytes

    def scan(batches):
        for batch in batches:
            ids, th = column(batch, "doc"), column(batch, "text_hash")
            for lo, hi, data, offsets in slices(column(batch, "text")):
                count, found = _fingerprints(data, offsets, lengths, window, gram, False, -2)
                kept = []
                for part in found:
                    ok = contains(bits.value, part[1])
                    kept.append(tuple(x[ok] for x in part))
                rows, hashes, at, size, context = _merge(kept, 2 * reach)
                structs = pa.StructArray.from_arrays(
                    [pa.array(hashes), pa.array(at), pa.array(size.astype(np.int32)), _lists(context)],
                    names=["h", "at", "size", "context"])
                ends = np.zeros(hi - lo + 1, np.int32)
                np.cumsum(np.bincount(rows, minlength=hi - lo), out=ends[1:])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), th.slice(lo, hi - lo), pa.array(count.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), structs)],
                    names=["doc", "text_hash", "n_words", "hits"])
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(text).cast("string")).alias("text_hash"))
    scanned = source.mapInArrow(
        scan, f"doc {kind}, text_hash long, n_words long, hits array<struct<h:long,at:long,size:int,context:array<long>>>")
    base = materialize(scanned.withColumn("row", F.monotonically_increasing_id()), "winnow-docs")

    hits = base.where(F.size("hits") > 0).select("row", F.explode("hits").alias("x")).select("row", "x.*")
    joined = hits.join(prints, (hits["h"] == prints["h"]) & (hits["size"] == prints["i_size"]))

    def agreeing(order: list[int]):
        """How many words agree, going outwards; ``order`` lists context indices from the gram on."""
        out = F.lit(len(order))
        for n in range(len(order) - 1, -1, -1):
            i = order[n]
            out = F.when(F.col("context")[i] != F.col("i_context")[i], F.lit(n)).otherwise(out)
        return out
    full = F.element_at("i_context", 1) != 0
    left = F.when(full, agreeing(list(range(reach - 1, -1, -1)))).otherwise(F.lit(0))
    right = F.when(full, agreeing(list(range(reach, 2 * reach)))).otherwise(F.lit(0))
    spans = (joined.withColumn("l", left).withColumn("r", right)
             .where(~full | (F.col("l") + F.col("r") + gram >= window))
             .select("row", "item", (F.col("at") - F.col("l")).alias("lo"),
                     (F.col("at") + F.col("size") + F.col("r")).alias("hi")))
    by_doc = spans.groupBy("row").agg(
        F.collect_set("item").alias("items"), F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("spans"))
    merged = F.expr("""aggregate(spans, cast(array() as array<struct<lo:bigint,hi:bigint>>),
        (a, s) -> case when size(a) = 0 or a[size(a) - 1].hi < s.lo then array_append(a, s)
                  else array_append(slice(a, 1, size(a) - 1),
                       named_struct('lo', a[size(a) - 1].lo, 'hi', greatest(a[size(a) - 1].hi, s.hi))) end)""")
    by_doc = by_doc.select("row", "items", merged.alias("spans"))
    ids = (by_doc.select("row", F.explode("items").alias("item")).join(classes.select("item", "ids"), "item")
           .groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items")))
    by_doc = by_doc.select("row", "spans").join(ids, "row")
    out = base.select("row", "doc", "n_words", "text_hash").join(by_doc, "row", "left")
    return out.select(
        F.col("doc").alias(doc_id), "n_words",
        F.expr("coalesce(aggregate(spans, 0L, (n, s) -> n + s.hi - s.lo), 0L)").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        F.coalesce("spans", F.expr("cast(array() as array<struct<lo:bigint,hi:bigint>>)")).alias("spans"),
        F.col("spans").isNotNull().alias("contaminated"), "text_hash")


def drop_contaminated(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that :func:`contamination` marks."""
    found = contamination(docs, items, doc_id=doc_id, text=text, **options).where("contaminated")
    gone = found.select(F.col(doc_id).alias("g_doc"), F.col("text_hash").alias("g_th")).distinct()
    gone = bounded(materialize(gone, "winnow-gone"))
    th = F.xxhash64(F.col(text).cast("string"))
    return docs.join(gone, (th == gone["g_th"]) & docs[doc_id].eqNullSafe(gone["g_doc"]), "left_anti")
