"""Removal of repeated passages by sliding spans of sentences.

From every sentence on, the shortest run of at least ``run`` sentences and
``min_words`` words is hashed, and as runs of their own a text of fewer than
``run`` sentences and a sentence of at least ``alone`` words.  Runs that occur more than once anywhere are
found by one global aggregate and join; the first occurrence in order of
document and position stays, and every sentence covered by another occurrence
is removed.  Words are compared by their hashes with A-Z folded, so spacing
and punctuation inside a run do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.groups import binary, column, lists
from zonecast.llm.shared import materialize
from zonecast.llm.textbytes import ALNUM, byte_class, prefix_hash, slices, span_hash, stream, word_hashes, words

RUN = 2
MIN_WORDS = 12
ALONE = 50                  # words of a sentence that is a run of its own
_STOP = byte_class((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
_WIDE_STOPS = (b"\xe3\x80\x82", b"\xef\xbc\x81", b"\xef\xbc\x9f")      # ideographic full stop, full-width ! and ?


def sentences(data: np.ndarray, offsets: np.ndarray):
    """``(row, start byte, first word, word hashes)`` of the sentences of a slice.

    A sentence ends behind ``.``, ``!`` or ``?`` before white space, behind
    their full-width forms, at a line feed and at the end of the text.  Its
    bytes run up to the next sentence; what has no words belongs to the
    sentence before, or after where there is none.
    """
    n = len(data)
    data = data.copy()
    for wide in _WIDE_STOPS if n >= 3 else ():         # their bytes are no part of words, and end a sentence
        at = np.flatnonzero((data[:-2] == wide[0]) & (data[1:-1] == wide[1]) & (data[2:] == wide[2]))
        data[at], data[at + 1], data[at + 2] = 0x2E, 0x2E, 0x0A
    start, end, row = words(data, offsets, ALNUM)
    hashes = word_hashes(data, start, end)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, hashes
    stops = np.zeros(n + 1, bool)              # a sentence may begin at i
    after = np.zeros(n, bool)
    after[:-1] = _SPACE[data[1:]]
    stops[1:] = (_STOP[data] & after) | (data == 0x0A)
    # a word begins a sentence if a stop, or a text, begins between the word before and it
    count = np.cumsum(stops)
    first = np.ones(len(start), bool)
    first[1:] = (count[start[1:]] > count[end[:-1] - 1]) | (row[1:] != row[:-1])
    lead = np.flatnonzero(first)
    at = start[lead]
    # its bytes begin at the white space's end behind the last stop, or at the text's begin
    opens = np.flatnonzero(stops)
    before = np.searchsorted(opens, at, "right") - 1
    begin = np.where(before >= 0, np.r_[opens, 0][np.maximum(before, 0)], 0)
    begin = np.maximum(begin, offsets[row[lead]])
    head = np.r_[True, row[lead][1:] != row[lead][:-1]]
    begin[head] = offsets[row[lead]][head]
    return row[lead], begin, lead, hashes


def runs(data: np.ndarray, offsets: np.ndarray, run: int, min_words: int, alone: int = ALONE):
    """``(row, sentence index in its text, sentences in the run, hash, second hash)``, and sentences per text."""
    n_rows = len(offsets) - 1
    row, _, lead, hashes = sentences(data, offsets)
    per = np.bincount(row, minlength=n_rows)
    if not len(row):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, per
    ends = np.r_[lead[1:], len(hashes)]
    last = np.cumsum(per)
    index = np.arange(len(row))
    to = np.maximum(index + run, np.searchsorted(ends, lead + min_words, "left") + 1)
    ok = to <= last[row]
    # a long sentence is a run of its own, and so is a text of too few sentences
    long = np.flatnonzero(ends - lead >= max(alone, min_words))
    few = np.flatnonzero((per > 0) & (per < run))
    few = few[ends[last[few] - 1] - lead[last[few] - per[few]] >= min_words]
    found = np.unique(np.r_[index[ok] * (len(row) + 1) + to[ok], long * (len(row) + 1) + long + 1,
                            (last[few] - per[few]) * (len(row) + 1) + last[few]])
    index, to = np.divmod(found, len(row) + 1)
    a, b = lead[index], ends[to - 1]
    h = span_hash(prefix_hash(hashes), a, b)
    h2 = span_hash(prefix_hash(stream(hashes, 7)), a, b) >> np.uint64(33)
    return row[index], index - (last - per)[row[index]], to - index, h.view(np.int64), h2.astype(np.int64), per


def remove_repeated_sentences(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", run: int = RUN,
                              min_words: int = MIN_WORDS, alone: int = ALONE) -> DataFrame:
    """Per document row: doc_id, n_sentences, n_removed, removed (sentence indexes), text (what is left).

    Order is by doc_id (null last), then by a hash of the text, then by
    position.  A null or empty text has no sentences and stays as it is; a
    text of fewer than ``min_words`` words loses nothing, one of fewer than
    ``run`` sentences goes as a whole.  A repeated sentence of fewer than
    ``alone`` words between differing neighbours stays.
    Rows equal in id and text are one document and keep or lose the same
    sentences.  Other columns are ignored; an empty table gives an empty
    result.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))

    def scan(batches):
        for batch in batches:
            for lo, hi, data, offsets in slices(column(batch, "text")):
                row, at, n, h, h2, per = runs(data, offsets, run, min_words, alone)
                spans = pa.StructArray.from_arrays(
                    [pa.array(h), pa.array(h2.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["h", "h2", "at", "n"])
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc").slice(lo, hi - lo), column(batch, "th").slice(lo, hi - lo), pa.array(per.astype(np.int64)),
                     lists(np.bincount(row, minlength=hi - lo), spans)], names=["doc", "th", "n_sentences", "spans"])
    keyed = source.withColumn("th", F.xxhash64("text"))
    scanned = keyed.select("doc", "th", "text").mapInArrow(
        scan, f"doc {kind}, th long, n_sentences long, spans array<struct<h:long,h2:int,at:int,n:int>>")
    base = materialize(scanned.withColumn("row", F.monotonically_increasing_id()), "sentence-spans")
    spans = base.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    # written first, so that both sides of the join have exchanges of their own, which Spark can split at a very common run
    often = materialize(spans.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"), "sentence-often")
    again = materialize(spans.join(often, "h").join(base.select("row", "doc", "th"), "row").drop("row"), "sentence-repeats")
    place = F.struct(F.col("doc").isNull().alias("a"), F.col("doc").alias("d"), F.col("th").alias("t"), F.col("at").alias("p"))
    first = materialize(again.groupBy("h", "h2").agg(F.min(place).alias("first")), "sentence-first")
    later = again.join(first, ["h", "h2"]).where(~(F.col("doc").eqNullSafe(F.col("first.d")) & (F.col("th") == F.col("first.t"))
                                                  & (F.col("at") == F.col("first.p"))))
    covers = later.groupBy("doc", "th").agg(F.collect_set(F.struct("at", "n")).alias("covers"))
    covers = covers.select(F.col("doc").alias("c_doc"), F.col("th").alias("c_th"), "covers")

    def remove(batches):
        for batch in batches:
            for lo, hi, data, offsets in slices(column(batch, "text")):
                part = column(batch, "covers").slice(lo, hi - lo)
                row, begin, _, _ = sentences(data, offsets)
                per = np.bincount(row, minlength=hi - lo)
                lead = np.r_[0, np.cumsum(per)]
                flat = part.flatten()
                of = np.repeat(np.arange(hi - lo), pc.fill_null(pc.list_value_length(part), 0).to_numpy())
                a = lead[of] + flat.field("at").to_numpy()
                depth = np.zeros(len(row) + 1, np.int64)
                np.add.at(depth, a, 1)
                np.add.at(depth, a + flat.field("n").to_numpy(), -1)
                gone = np.cumsum(depth[:-1]) > 0
                # every byte belongs to the sentence that began last in its text
                close = np.r_[begin[1:], len(data)]
                close = np.minimum(close, offsets[row + 1]) if len(row) else close[:0]
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, begin[gone], 1)
                np.add.at(edge, close[gone], -1)
                out = np.cumsum(edge[:-1]) > 0
                n_out = np.add.reduceat(np.r_[out, False], offsets[:-1]) * (np.diff(offsets) > 0) if len(data) else np.zeros(hi - lo, np.int64)
                kept = binary(data[~out], np.diff(offsets) - n_out).cast(pa.string())
                text_ = pc.if_else(pc.is_null(column(batch, "text").slice(lo, hi - lo)), None, kept)
                where = np.flatnonzero(gone)
                n_gone = np.bincount(row[gone], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc").slice(lo, hi - lo), pa.array(per.astype(np.int64)), pa.array(n_gone.astype(np.int64)),
                     lists(n_gone, pa.array(where - lead[row[where]])), text_],
                    names=["doc", "n_sentences", "n_removed", "removed", "text"])
    both = keyed.join(covers, (keyed["th"] == covers["c_th"]) & keyed["doc"].eqNullSafe(covers["c_doc"]), "left")
    out = both.select("doc", "text", "covers").mapInArrow(
        remove, f"doc {kind}, n_sentences long, n_removed long, removed array<long>, text string")
    return out.withColumnsRenamed({"doc": doc_id, "text": text})
