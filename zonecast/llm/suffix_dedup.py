"""Byte-exact removal of long repeats by threshold-bounded suffix intervals.

A byte string of ``length`` bytes that occurs twice contains, at the same
offset in both places, the same *anchor*: the ``gram``-byte string with the
smallest hash among those that start in it.  So only texts around anchors
that occur at least twice can repeat, and two places can only match within
one anchor's group.

For each group the suffixes that begin with the anchor are sorted by what
follows it (the suffix array of the group, an interval of the common prefix
``gram``).  Breadth-first backward extension then prepends one byte at a time:
the bytes before the suffixes are the Burrows-Wheeler column, and a stable
partition of every interval by that column is the LF step.  After ``e`` steps
an interval's common prefix is ``e`` longer on the left, so its members need
``length - gram - e`` equal bytes on the right: the threshold on the common
prefix falls by one per step, intervals with a single member go, and the
search ends when the threshold reaches the anchor itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm.bloom import build, contains
from zonecast.llm.groups import binary, by_group, column, lists
from zonecast.llm.shared import bounded, drop, materialize, written
from zonecast.llm.textbytes import BYTE_VALUES, mix, prefix_hash, slices, span_hash

LENGTH = 400
GROUP = 8192         # contexts of one anchor searched in one task; larger groups are split by longer keys
PARTS = 4
FILTER_BITS = 1 << 27        # which texts hold a place to look at: 16 MB whatever the corpus
_POSITION_BITS = np.uint64(32)


def sliding_min(key: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by block-wise running minima from both sides."""
    m = len(key) - w + 1
    x = np.concatenate([key, np.full((-len(key)) % w, np.uint64(2**64 - 1))]).reshape(-1, w)
    ahead = np.minimum.accumulate(x, 1).ravel()
    behind = np.minimum.accumulate(x[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:m], ahead[w - 1:w - 1 + m])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """``(row, position, gram hash, context hash)`` of the anchors of every text in a slice.

    The context of an anchor is what any window around it can reach:
    ``length - gram`` bytes before it and after it, cut at the ends of the text.
    """
    w = length - gram + 1
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    prefix = prefix_hash(BYTE_VALUES[data])
    at = np.arange(len(data) - gram + 1)
    value = span_hash(prefix, at, at + gram)
    low = sliding_min((value >> _POSITION_BITS << _POSITION_BITS) | at.astype(np.uint64), w)
    whole = np.zeros(len(low), np.int32)        # windows inside one text
    longer = offsets[1:] - offsets[:-1] >= length
    np.add.at(whole, offsets[:-1][longer], 1)
    ends = offsets[1:][longer] - length + 1
    np.add.at(whole, ends[ends < len(low)], -1)
    low = low[np.cumsum(whole) > 0]
    at = np.unique((low & np.uint64((1 << 32) - 1)).astype(np.int64))
    row = np.searchsorted(offsets, at, "right") - 1
    lo, hi = np.maximum(offsets[row], at - (length - gram)), np.minimum(offsets[row + 1], at + length)
    context = mix(span_hash(prefix, lo, hi) + ((at - lo) * 65536 + (hi - at)).astype(np.uint64))
    return row, at - offsets[row], value[at], context


def _matrix(column_: pa.Array, width: int, reverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a binary column as a zero-padded byte matrix, and their lengths."""
    if isinstance(column_, pa.ChunkedArray):
        column_ = column_.combine_chunks()
    column_ = column_.cast(pa.large_binary())
    n = len(column_)
    offsets = np.frombuffer(column_.buffers()[1], np.int64)[column_.offset:column_.offset + n + 1]
    data = np.frombuffer(column_.buffers()[2], np.uint8) if column_.buffers()[2] is not None else np.zeros(0, np.uint8)
    size = np.minimum(offsets[1:] - offsets[:-1], width)
    step = np.arange(width)
    where = (offsets[1:, None] - 1 - step) if reverse else (offsets[:-1, None] + step)
    inside = step < size[:, None]
    out = np.zeros((n, width), np.uint8)
    if len(data):
        out[inside] = data[where[inside]]
    return out, size


def backward_extension(group: np.ndarray, left: np.ndarray, n_left: np.ndarray, right: np.ndarray,
                       n_right: np.ndarray, span: int, rank: np.ndarray | None = None) -> np.ndarray:
    """Which windows repeat: ``out[i, e]`` for the window that begins ``e`` bytes before member ``i``'s anchor.

    ``left[i, j]`` is byte ``j`` counted backwards from the anchor, ``right[i, j]``
    byte ``j`` behind it; a window takes ``e`` bytes of the one and ``span - e`` of
    the other.  Members of one group share the anchor.  With ``rank`` the member
    of least rank among those with an equal window is spared.
    """
    n = len(group)
    out = np.zeros((n, span + 1), bool)
    pad = -span % 8
    wide = np.pad(right, ((0, 0), (0, pad))) if pad else right
    parts = np.ascontiguousarray(wide).view(">u8") if span else np.zeros((n, 0), np.uint64)
    order = np.lexsort([n_right, *parts.T[::-1], group])          # the suffix array
    # common prefixes of neighbours behind the anchor; -1 between groups
    a, b = order[:-1], order[1:]
    differ = right[a] != right[b]
    common = np.where(differ.any(1), differ.argmax(1), span) if span else np.zeros(len(a), np.int64)
    common = np.minimum(common, np.minimum(n_right[a], n_right[b]))
    common = np.r_[-1, np.where(group[a] == group[b], common, -1)]
    # intervals are runs of equal ``part``; members stay in suffix order within them
    member = np.arange(n)                      # places in ``order``
    part = np.cumsum(np.r_[False, group[a] != group[b]])
    for e in range(span + 1):
        cls = np.cumsum(common < span - e)     # equal class: enough common bytes behind the anchor
        mine = cls[member]
        same = (part[1:] == part[:-1]) & (mine[1:] == mine[:-1])
        hit = np.r_[same, False] | np.r_[False, same]
        if rank is not None:
            begin = np.flatnonzero(np.r_[True, ~same])
            place = rank[order[member]]
            hit &= place != np.repeat(np.minimum.reduceat(place, begin), np.diff(np.r_[begin, len(member)]))
        out[order[member[hit]], e] = True
        if e == span:
            break
        # members whose text goes on to the left, then the LF step
        who = order[member]
        go = n_left[who] > e
        member, part = member[go], part[go]
        key = part.astype(np.int64) * 256 + left[order[member], e]
        step = np.argsort(key, kind="stable")
        member, key = member[step], key[step]
        fresh = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        part = np.cumsum(fresh) - 1
        keep = np.bincount(part, minlength=1)[part] > 1 if len(part) else fresh
        member, part = member[keep], part[keep]
        if not len(member):
            break
    return out


# ``o, t, p`` say where the context stands first: id, row and position.
_CONTEXT = "g long, c long, o long, t long, p int, k long, shift int, l binary, r binary"
_NAMES = ["g", "c", "o", "t", "p", "k", "shift", "l", "r"]
# All windows of a context hold its anchor, so together they cover one range.
_SPANS = "g long, c long, lo int, hi int"


def _search(contexts: DataFrame, span: int, length: int, keep_first: bool) -> DataFrame:
    """Backward extension within every group ``k``."""
    def run(batches):
        for t in by_group(batches, "k", GROUP):
            group = t.column("k").to_numpy()
            left, n_left = _matrix(t.column("l"), span, True)
            right, n_right = _matrix(t.column("r"), span, False)
            rank = None
            if keep_first:
                first = [t.column(name).to_numpy() for name in ("p", "t", "o")]
                step = np.lexsort(first)
                rank = np.empty(len(group), np.int64)      # a context that came twice has one rank
                rank[step] = np.cumsum(np.r_[False, np.any([f[step][1:] != f[step][:-1] for f in first], 0)])
            marks = backward_extension(group, left, n_left, right, n_right, span, rank)
            keep = np.flatnonzero(marks.any(1))
            t, marks = t.take(pa.array(keep)), marks[keep]
            shift = t.column("shift").to_numpy()
            lo, hi = marks[:, ::-1].argmax(1) - span - shift, length - marks.argmax(1) - shift
            yield pa.RecordBatch.from_arrays(
                [t.column("g").combine_chunks(), t.column("c").combine_chunks(), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                names=["g", "c", "lo", "hi"])
    return contexts.repartition("k").sortWithinPartitions("k").mapInArrow(run, _SPANS)


def _ends_hash(t, span: int, take_left: np.ndarray, take_right: np.ndarray, left, right) -> np.ndarray:
    """A hash of the first bytes on either side of each anchor."""
    def part(m, take):
        values = BYTE_VALUES[m] * mix(np.arange(1, m.shape[1] + 1, dtype=np.uint64))[None, :]
        c = np.concatenate([np.zeros((len(m), 1), np.uint64), np.cumsum(values, 1)], 1)
        return np.take_along_axis(c, take[:, None], 1)[:, 0]
    return mix(mix(part(left, take_left) + np.uint64(1)) + part(right, take_right))


def _finer(contexts: DataFrame, span: int) -> DataFrame:
    """Groups split by longer keys: ``PARTS`` rows a context, each for its share of the windows.

    Windows that begin ``e`` in ``[q, q + share]`` bytes before the anchor all
    hold ``q`` bytes before it and ``span - q - share`` behind it, so only
    contexts equal there can match.
    """
    share = span // PARTS

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, n_left = _matrix(column(batch, "l"), span, True)
            right, n_right = _matrix(column(batch, "r"), span, False)
            k = column(batch, "k").to_numpy().view(np.uint64)
            shift = column(batch, "shift").to_numpy()
            for q in range(0, span, share):
                rest = span - q - share
                ok = np.flatnonzero((n_left >= q) & (n_right >= rest))
                if not len(ok):
                    continue
                ends = _ends_hash(batch, span, np.full(len(ok), q), np.full(len(ok), rest), left[ok], right[ok])
                key = mix(ends ^ mix(k[ok] + np.uint64(q + 1)))
                more_left, more_right = np.minimum(n_left[ok] - q, share), np.minimum(n_right[ok] - rest, share)
                inside = np.arange(share)
                l_bytes = left[ok, q:q + share][:, ::-1][(share - 1 - inside)[None, :] < more_left[:, None]]
                r_bytes = right[ok, rest:rest + share][inside[None, :] < more_right[:, None]]
                yield pa.RecordBatch.from_arrays(
                    [*[column(batch, name).take(pa.array(ok)) for name in ("g", "c", "o", "t", "p")], pa.array(key.view(np.int64)),
                     pa.array((shift[ok] + q).astype(np.int32)), binary(l_bytes, more_left), binary(r_bytes, more_right)], names=_NAMES)
    return contexts.mapInArrow(run, _CONTEXT)


def _windows(contexts: DataFrame, span: int) -> DataFrame:
    """One row per window of each context: (g, c, o, t, p, shift of the window's begin, w)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, n_left = _matrix(column(batch, "l"), span, True)
            right, n_right = _matrix(column(batch, "r"), span, False)
            k = column(batch, "k").to_numpy().view(np.uint64)
            shift = column(batch, "shift").to_numpy()
            for e in range(span + 1):
                ok = np.flatnonzero((n_left >= e) & (n_right >= span - e))
                if not len(ok):
                    continue
                ends = _ends_hash(batch, span, np.full(len(ok), e), np.full(len(ok), span - e), left[ok], right[ok])
                yield pa.RecordBatch.from_arrays(
                    [*[column(batch, name).take(pa.array(ok)) for name in ("g", "c", "o", "t", "p")],
                     pa.array((shift[ok] + e).astype(np.int32)), pa.array(mix(ends ^ mix(k[ok] + np.uint64(e + 1))).view(np.int64))],
                    names=["g", "c", "o", "t", "p", "e", "w"])
    return contexts.mapInArrow(run, "g long, c long, o long, t long, p int, e int, w long")


def _halves(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contexts of groups that one task searches, and of larger ones."""
    return sized.where(F.col("n") <= GROUP).drop("n"), sized.where(F.col("n") > GROUP).drop("n")


def repeated_spans(contexts: DataFrame, span: int, length: int, keep_first: bool = False) -> DataFrame:
    """The range (relative to the anchor) that repeats, for context rows (g, c, o, t, p, k, shift, l, r, n).

    ``n`` counts the contexts of the anchor.  Groups of more than ``GROUP``
    are split by longer keys; what is then still larger is settled window by
    window, by counting equal ones.  Counts are written before they are joined,
    so that the partition of a very common key is a plain shuffle that the
    skew join can split.
    """
    spark = contexts.sparkSession
    contexts, path = written(contexts, "suffix-contexts")
    small, large = _halves(contexts)
    found = materialize(_search(small, span, length, keep_first), "suffix-spans")
    if not large.isEmpty():
        share = span // PARTS
        finer, finer_path = written(_finer(large, span), "suffix-finer")
        sizes = materialize(finer.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "suffix-sizes")      # lone contexts go
        small, large = _halves(finer.join(bounded(sizes), "k"))
        more = _search(small, share, length, keep_first)
        windows, windows_path = written(_windows(large, share), "suffix-windows")
        twice = windows.groupBy("w").agg(F.min("c").alias("a"), F.max("c").alias("z"), F.min(F.struct("o", "t", "p", "c")).alias("first"))
        twice = materialize(twice.where("a <> z").select("w", F.col("first.c").alias("spared")), "suffix-twice")
        exact = windows.join(bounded(twice), "w")
        if keep_first:
            exact = exact.where("c <> spared")
        exact = exact.select("g", "c", (-F.col("e")).alias("lo"), (F.lit(length) - F.col("e")).alias("hi"))
        more = more.union(exact).groupBy("g", "c").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        found = found.union(materialize(more, "suffix-spans"))
        drop(spark, finer_path)
        drop(spark, windows_path)
    drop(spark, path)
    return found


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   whole_characters: bool = False, keep_first: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, spans (removed byte ranges, merged), kept (binary).

    Every byte covered by a ``length``-byte string that also starts somewhere
    else, in any text or the same one (overlaps count), is removed; what
    repeats is judged on the input.  With ``keep_first`` the first occurrence
    of each such string does not count: the one of the smallest id (null ids
    first; ids that are no integers by their hash), rows that share an id in
    the order of the table, then the earliest in the text; rows equal in id
    and text are treated as one.  With ``whole_characters`` a character
    goes only if all its bytes are covered, so ``kept`` stays valid UTF-8.
    A null text is empty; a text shorter than ``length`` loses nothing;
    repeated rows repeat each other.  ``keep`` names further columns to carry
    along; others are ignored.  ``length`` must be a multiple of 8.
    """
    if length % 8 or length < 16:
        raise ValueError("length must be a multiple of 8, 16 at least")
    gram = length // 2
    span = length - gram
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"),
                         F.struct(F.lit(0).alias("_"), *[docs[c] for c in keep]).alias("kept_columns"))
    source = source.withColumn("th", F.xxhash64("text"))

    def scan(batches):
        for batch in batches:
            for lo, hi, data, offsets in slices(column(batch, "text")):
                row, at, g, c = anchors(data, offsets, length, gram)
                found = pa.StructArray.from_arrays(
                    [pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), pa.array(at.astype(np.int32))], names=["g", "c", "at"])
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc").slice(lo, hi - lo), column(batch, "th").slice(lo, hi - lo),
                     pa.array(np.diff(offsets)), lists(np.bincount(row, minlength=hi - lo), found)],
                    names=["doc", "th", "n", "anchors"])
    scanned = source.select("doc", "th", "text").mapInArrow(
        scan, f"doc {kind}, th long, n long, anchors array<struct<g:long,c:long,at:int>>")
    order = F.col("doc").cast("long") if isinstance(docs.schema[doc_id].dataType, T.IntegralType) else F.xxhash64("doc")
    base = materialize(scanned.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "o", F.coalesce(order, F.lit(-(1 << 63)).cast("long"))), "suffix-anchors")
    occ = base.select("row", "o", F.explode("anchors").alias("x")).select("row", "o", "x.*")

    grams = occ.groupBy("g").agg(F.count("*").alias("total"), F.min("c").alias("a"), F.max("c").alias("z"))
    grams = materialize(grams.where("total > 1").select("g", (F.col("a") != F.col("z")).alias("several")), "suffix-grams")
    hits = materialize(occ.join(grams, "g"), "suffix-hits")

    # One place for every different context of an anchor that has several.
    places = materialize(hits.where("several").groupBy("g", "c").agg(
        F.count("*").alias("times"), F.min(F.struct("o", "row", "at")).alias("p")), "suffix-places")
    sizes = materialize(places.groupBy("g").agg(F.count("*").alias("n")), "suffix-sizes")
    wanted = places.select("g", "c", "p.row", "p.at").join(bounded(sizes), "g")
    wanted = wanted.groupBy("row").agg(F.collect_list(F.struct("g", "c", "at", "n")).alias("places"))
    wanted = wanted.join(base.select("row", "o", F.col("doc").alias("w_doc"), F.col("th").alias("w_th")), "row")
    wanted = materialize(wanted, "suffix-wanted")
    bits = docs.sparkSession.sparkContext.broadcast(build(wanted, "w_th", FILTER_BITS))       # FILTER_BITS / 8 bytes

    def thin(batches):
        for batch in batches:
            yield batch.filter(pa.array(contains(bits.value, column(batch, "th").to_numpy())))
    texts = source.select("doc", "th", "text")
    texts = texts.mapInArrow(thin, texts.schema)
    texts = texts.join(wanted, (texts["th"] == wanted["w_th"]) & texts["doc"].eqNullSafe(wanted["w_doc"])).select("text", "places", "o", "row")

    def cut(batches):
        for batch in batches:
            for lo, hi, data, offsets in slices(column(batch, "text")):
                part = column(batch, "places").slice(lo, hi - lo)
                row = np.repeat(np.arange(hi - lo), pc.list_value_length(part).to_numpy())
                flat = part.flatten()
                at = flat.field("at").to_numpy() + offsets[row]
                a, b = np.maximum(offsets[row], at - span), np.minimum(offsets[row + 1], at + length)
                k = flat.field("g")
                yield pa.RecordBatch.from_arrays(
                    [k, flat.field("c"), *[column(batch, name).slice(lo, hi - lo).take(pa.array(row)) for name in ("o", "row")], flat.field("at"),
                     k, pa.array(np.zeros(len(row), np.int32)), _pieces(data, a, at), _pieces(data, at + gram, b), flat.field("n")],
                    names=[*_NAMES, "n"])
    # a document that stands twice under one id gives its places twice
    contexts = texts.mapInArrow(cut, _CONTEXT + ", n long")
    found = repeated_spans(contexts, span, length, keep_first)

    # A context that occurs more than once repeats as a whole (cut to the text below).
    whole = (F.lit(-span), F.lit(length))
    often = places.where("times > 1").select("g", "c", "p", F.lit(True).alias("whole")).join(found, ["g", "c"], "full")
    often = materialize(often, "suffix-ranges")
    one_context = hits.where("not several")
    if keep_first:
        # spared: the first occurrence, but for what repeats an earlier text of another context
        leads = materialize(one_context.groupBy("g").agg(F.min(F.struct("o", "row", "at")).alias("p")), "suffix-leads")
        later = (F.struct("o", "row", "at") > F.col("p"))
        once = one_context.join(bounded(leads), "g").where(later)
        covered = hits.where("several").join(often, ["g", "c"]).withColumn("whole", F.col("whole") & later)
        covered = covered.where(F.col("whole") | F.col("lo").isNotNull())
    else:
        once, covered = one_context, hits.where("several").join(often, ["g", "c"])
    covers = once.select("row", "at", whole[0].alias("lo"), whole[1].alias("hi")).union(covered.select(
        "row", "at", F.when(F.col("whole"), whole[0]).otherwise(F.col("lo")), F.when(F.col("whole"), whole[1]).otherwise(F.col("hi"))))
    covers = covers.groupBy("row").agg(F.collect_list(F.struct(
        (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi"))).alias("spans"))
    one = base.groupBy("doc", "th").agg(F.min("row").alias("row"))
    covers = covers.join(one, "row").select(F.col("th").alias("c_th"), F.col("doc").alias("c_doc"), "spans")

    def remove(batches):
        for batch in batches:
            for lo, hi, data, offsets in slices(column(batch, "text")):
                part = column(batch, "spans").slice(lo, hi - lo)
                flat = part.flatten()
                row = np.repeat(np.arange(hi - lo), pc.fill_null(pc.list_value_length(part), 0).to_numpy())
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, np.maximum(flat.field("lo").to_numpy() + offsets[row], offsets[row]), 1)
                np.add.at(depth, np.minimum(flat.field("hi").to_numpy() + offsets[row], offsets[row + 1]), -1)
                gone = np.cumsum(depth[:-1]) > 0
                if whole_characters:
                    lead = np.flatnonzero((data & 0xC0) != 0x80)
                    if len(lead):
                        gone = np.repeat(np.logical_and.reduceat(gone, lead), np.diff(np.r_[lead, len(data)]))
                of = np.repeat(np.arange(hi - lo), np.diff(offsets))
                begin, end = gone.copy(), gone.copy()
                begin[1:] &= ~gone[:-1] | (of[1:] != of[:-1])
                end[:-1] &= ~gone[1:] | (of[1:] != of[:-1])
                a, b = np.flatnonzero(begin), np.flatnonzero(end) + 1
                at = of[a] if len(a) else np.zeros(0, np.int64)
                ranges = pa.StructArray.from_arrays([pa.array(a - offsets[at]), pa.array(b - offsets[at])], names=["lo", "hi"])
                kept = data[~gone]
                n_removed = np.bincount(of[gone], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc").slice(lo, hi - lo), pa.array(np.diff(offsets)), pa.array(n_removed.astype(np.int64)),
                     lists(np.bincount(at, minlength=hi - lo), ranges), binary(kept, np.diff(offsets) - n_removed),
                     column(batch, "kept_columns").slice(lo, hi - lo)],
                    names=["doc", "n_bytes", "n_removed", "spans", "kept", "kept_columns"])
    both = source.join(covers, (source["th"] == covers["c_th"]) & source["doc"].eqNullSafe(covers["c_doc"]), "left")
    extra = source.schema["kept_columns"].dataType.simpleString()
    out = both.select("doc", "text", "spans", "kept_columns").mapInArrow(
        remove, f"doc {kind}, n_bytes long, n_removed long, spans array<struct<lo:long,hi:long>>, kept binary, kept_columns {extra}")
    return out.select(F.col("doc").alias(doc_id), "n_bytes", "n_removed", "spans", "kept",
                      *[F.col(f"kept_columns.{c}").alias(c) for c in keep])


def _pieces(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """The byte ranges ``[a, b)`` as a binary column."""
    size = np.maximum(b - a, 0)
    where = np.repeat(a - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    return binary(data[where], size)
