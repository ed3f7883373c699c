"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text becomes its letters, lower-cased, with one space between runs of them;
every 1- to 3-gram is hashed into one of ``BUCKETS`` classes.  Counts by
language are summed by Spark over all training rows; the log-probability
matrix (one row of 256 KB per language) is broadcast, and whole batches are
scored as sparse count rows against it in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm.groups import column
from zonecast.llm.textbytes import MULTIPLIER, mix, slices

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point: its lower-case form if it is a letter, else a space."""
    out = np.full(0x110000, 0x20, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = data.tobytes()
    try:
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        return points, lead[offsets]
    except UnicodeError:        # bytes that are no UTF-8: text by text
        each = [np.frombuffer(raw[a:b].decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return np.concatenate(each), np.r_[0, np.cumsum([len(x) for x in each])]


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, bucket, count)`` of a slice's n-grams, sorted, and the number of letters of each row."""
    points, ends = _code_points(data, offsets)
    n_rows = len(offsets) - 1
    letter = _letters()[points]
    row = np.repeat(np.arange(n_rows), np.diff(ends))
    space = letter == 0x20
    # a run of other characters is one space; texts are apart
    keep = ~space
    keep[1:] |= ~space[:-1] & (row[1:] == row[:-1])
    letter, row = letter[keep].astype(np.uint64), row[keep]
    n_letters = np.bincount(row[letter != 0x20], minlength=n_rows)
    found = []
    for k in ORDERS:
        n = len(letter) - k + 1
        if n <= 0:
            continue
        h = np.full(n, k, np.uint64)
        for j in range(k):
            h = (h + letter[j:j + n]) * MULTIPLIER
            h ^= h >> np.uint64(31)
        h = mix(h) >> np.uint64(64 - BUCKET_BITS)
        inside = row[:n] == row[k - 1:]
        found.append((row[:n][inside] << BUCKET_BITS) | h[inside].astype(np.int64))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, n_letters
    key = np.concatenate(found)
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(key)])
    key = key[first]
    return key >> BUCKET_BITS, key & (BUCKETS - 1), count, n_letters


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]        # in code-point order
    prior: np.ndarray                 # log share of rows
    table: np.ndarray                 # float32, BUCKETS x languages: log probabilities


def fit(rows: DataFrame, *, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Count every n-gram of every row with a language; rows without one are left out.

    What reaches the driver is one count per language and bucket.
    """
    known = rows.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null")

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        n_rows: dict[str, int] = {}
        for batch in batches:
            names = column(batch, "lang").to_pylist()
            for lo, hi, data, offsets in slices(column(batch, "text")):
                row, bucket, n, _ = grams(data, offsets)
                kinds, code = np.unique(np.array(names[lo:hi], object), return_inverse=True)
                dense = np.bincount(code[row] * BUCKETS + bucket, n, len(kinds) * BUCKETS).reshape(len(kinds), BUCKETS)
                for i, name in enumerate(kinds):
                    n_rows[name] = n_rows.get(name, 0) + int((code == i).sum())
                    sums[name] = sums[name] + dense[i] if name in sums else dense[i]
        for name, value in sums.items():
            at = np.flatnonzero(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(at) + 1), pa.string()), pa.array(np.r_[at, -1]),
                 pa.array(np.r_[value[at].astype(np.int64), n_rows[name]])], names=["lang", "bucket", "n"])
    got = (known.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))).toArrow()
    names = got.column("lang").to_pylist()
    languages = tuple(sorted(set(names)))
    at = {name: i for i, name in enumerate(languages)}
    code = np.array([at[x] for x in names], np.int64)
    bucket, n = got.column("bucket").to_numpy(), got.column("n").to_numpy()
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    gram = bucket >= 0
    table[bucket[gram], code[gram]] += n[gram]
    shares = np.zeros(len(languages))
    shares[code[~gram]] = n[~gram]
    return LanguageModel(languages, np.log(np.maximum(shares, 1e-9) / max(shares.sum(), 1e-9)),
                         np.log(table / table.sum(0)).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior probability of that language.

    A text that is null or has no letter is ``und`` with score 0, and so is
    every text if nothing was learned.  Ties go to the first language by code
    point.  Columns of those names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.prior, model.table))

    def run(batches):
        languages, prior, table = shared.value
        for batch in batches:
            for lo, hi, data, offsets in slices(column(batch, text)):
                row, bucket, n, letters = grams(data, offsets)
                k = len(languages)
                if k:
                    total = np.tile(prior, (hi - lo, 1))
                    for j in range(0, k, 16):       # a few languages at a time
                        part = table[:, j:j + 16][bucket] * n[:, None]
                        c = np.concatenate([np.zeros((1, part.shape[1])), np.cumsum(part, 0, dtype=np.float64)])
                        end = np.cumsum(np.bincount(row, minlength=hi - lo))
                        total[:, j:j + 16] += c[end] - c[np.r_[0, end[:-1]]]
                    best = total.argmax(1)
                    top = np.exp(total - total.max(1, keepdims=True))
                    p = np.where(letters > 0, 1 / top.sum(1), 0.0)
                    names = [languages[b] if m else UNKNOWN for b, m in zip(best, letters, strict=True)]
                else:
                    p, names = np.zeros(hi - lo), [UNKNOWN] * (hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(lo, hi - lo) for c in batch.columns] + [pa.array(names, pa.string()), pa.array(p)],
                    names=[*batch.schema.names, "lang_pred", "score"])
    docs = docs.drop("lang_pred", "score")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                                              T.StructField("score", T.DoubleType())]))
