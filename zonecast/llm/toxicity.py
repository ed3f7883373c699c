"""Toxicity by a counterfactually regularised linear classifier.

Features are the hashed words of a text and their hashed beginnings, each
present or not.  A logistic model is fitted to a bounded sample of labelled
documents.  For every sentence of the sample that names a group of people,
the name is swapped for another of its kind, and the difference between the
two scores is penalised: the model may not lean on who is mentioned, only on
what is said.  Scoring is one pass over all documents with the weight vector
broadcast (1 MB, whatever the corpus).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm.groups import column, lists
from zonecast.llm.shared import materialize
from zonecast.llm.textbytes import ALNUM, FOLDED_VALUES, prefix_hash, slices, span_hash, stream, words

FEATURE_BITS = 18
PREFIXES = (4, 5, 6)
# The sample: so many labelled documents of either class at most, smallest id hash first.
SAMPLE_PER_CLASS = 5000
SAMPLE_BYTES = 256 << 20
MIN_ROWS = 3
ITERATIONS = 80
L2 = 1.0
COUNTERFACTUAL = 1.0
CHUNK = 1 << 20               # entries of the sample that the fit widens at a time

# Names of groups of people, by kind (fixed values; pass others for other corpora).
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual"),
    ("black", "white", "asian", "latino", "african", "arab", "european"),
    ("americans", "mexicans", "chinese", "indians", "russians", "germans", "french"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("old", "young", "elderly", "teenage"),
    ("blind", "deaf", "disabled", "autistic"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "katholiken"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "catholiques"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("musulmanes", "cristianos", "judíos", "católicos"),
)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text as ``(row, feature)``, sorted by both."""
    start, end, row = words(data, offsets, ALNUM)
    prefix = prefix_hash(FOLDED_VALUES[data])
    shift = np.uint64(64 - FEATURE_BITS)
    found = [span_hash(prefix, start, end) >> shift]
    found += [stream(span_hash(prefix, start, np.minimum(end, start + k)), k) >> shift for k in PREFIXES]
    key = np.concatenate([(row << FEATURE_BITS) | f.astype(np.int64) for f in found])
    key.sort()
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    return key >> FEATURE_BITS, key & ((1 << FEATURE_BITS) - 1)


def swapped_sentences(text: str, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> list[tuple[str, str]]:
    """Sentences of the text that hold an identity term, each with every term replaced by the next of its kind."""
    other = {a: kind[(i + 1) % len(kind)] for kind in terms for i, a in enumerate(kind)}
    out = []
    for sentence in text.replace("!", ".").replace("?", ".").replace("\n", ".").split("."):
        parts = sentence.lower().split()
        bare = [p.strip(",;:\"'()") for p in parts]
        if any(b in other for b in bare):
            out.append((" ".join(bare), " ".join(other.get(b, b) for b in bare)))
    return out


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray          # float32, 2 ** FEATURE_BITS
    bias: float


def _parts(ends: np.ndarray):
    """Row ranges ``(lo, hi)`` of about ``CHUNK`` entries; the driver widens no more than that at a time."""
    cuts = np.unique(np.r_[np.searchsorted(ends, np.arange(0, ends[-1], CHUNK)), len(ends) - 1])
    return zip(cuts[:-1], cuts[1:], strict=True)


def _dot(w, ends, index):
    """The sum of ``w`` over the entries of every row."""
    out = np.zeros(len(ends) - 1)
    for lo, hi in _parts(ends):
        at = ends[lo:hi + 1] - ends[lo]
        c = np.r_[0.0, np.cumsum(w[index[ends[lo]:ends[hi]]], dtype=np.float64)]
        out[lo:hi] = c[at[1:]] - c[at[:-1]]
    return out


def _spread(values, ends, index, d):
    """Per entry number below ``d``: the sum of ``values`` over the rows that hold it."""
    out = np.zeros(d)
    for lo, hi in _parts(ends):
        out += np.bincount(index[ends[lo]:ends[hi]], np.repeat(values[lo:hi], np.diff(ends[lo:hi + 1])), d)
    return out


def fit_rows(ends: np.ndarray, index: np.ndarray, y: np.ndarray, pairs) -> ToxicityModel:
    """Regularised logistic regression over sparse rows by limited-memory BFGS.

    The loss is the sum of the log loss, ``COUNTERFACTUAL`` times the squared
    score gap of every pair (two sets of rows whose scores should agree) and
    an L2 term.  Features of fewer than ``MIN_ROWS`` rows keep weight 0.
    """
    d = 1 << FEATURE_BITS
    common = _spread(np.ones(len(y)), ends, index, d) >= MIN_ROWS
    own, swapped = pairs[:2], pairs[2:]

    def loss(w):
        z = _dot(w, ends, index) + w[d]
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        gap = _dot(w, *own) - _dot(w, *swapped)
        value = np.logaddexp(0, z).sum() - y @ z + COUNTERFACTUAL * gap @ gap + 0.5 * L2 * w[:d] @ w[:d]
        grad = _spread(p - y, ends, index, d) * common + L2 * w[:d]
        if len(gap):
            g = 2 * COUNTERFACTUAL * gap
            grad += (_spread(g, *own, d) - _spread(g, *swapped, d)) * common
        return value, np.r_[grad, (p - y).sum()]

    w = np.zeros(d + 1)
    value, grad = loss(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(ITERATIONS):
        q, back = grad.copy(), []
        for s, t in reversed(steps):
            back.append((s @ q) / (s @ t))
            q -= back[-1] * t
        q *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(1.0, np.abs(grad).sum())
        for (s, t), x in zip(steps, reversed(back), strict=True):
            q += s * (x - (t @ q) / (s @ t))
        rate = 1.0
        while True:
            moved = w - rate * q
            new, new_grad = loss(moved)
            if new <= value - 1e-4 * rate * (grad @ q) or rate < 1e-6:
                break
            rate /= 2
        if (moved - w) @ (new_grad - grad) > 1e-12:
            steps = [*steps[-7:], (moved - w, new_grad - grad)]
        done = abs(value - new) <= 1e-4 * abs(value)
        w, value, grad = moved, new, new_grad
        if done:
            break
    return ToxicityModel(w[:d].astype(np.float32), float(w[d]))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_per_class: int = SAMPLE_PER_CLASS, sample_bytes: int = SAMPLE_BYTES, terms=IDENTITY_TERMS) -> ToxicityModel:
    """Fit to the labelled documents: ``labels`` has ``doc_id`` and a 0/1 ``label``.

    At most ``sample_per_class`` rows of either class are used, picked by a
    hash of the id, and only their features reach the driver: at most
    ``sample_bytes`` of text, longer texts first to go (one of equal texts of
    an id counts, and of an id with several texts the one of least hash, so an
    id that stands in many rows is one row of the sample).  Null ids and
    labels are left out.  With one class only, every score is that class's
    smoothed share.
    """
    known = labels.select(F.col(doc_id).alias("doc"), F.col(label).cast("int").alias("y")).where("doc is not null and y in (0, 1)")
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(counts) < 2:
        share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1.0)
        return ToxicityModel(np.zeros(1 << FEATURE_BITS, np.float32), float(np.log(share / (1 - share))))
    by_hash = [F.xxhash64("doc"), F.col("doc")]
    sample = known.where("y = 0").orderBy(*by_hash).limit(sample_per_class).union(
        known.where("y = 1").orderBy(*by_hash).limit(sample_per_class))
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text")).join(F.broadcast(sample), "doc")
    # one row a label, and a bound on what the driver gets; the table is as large as the sample at most
    texts = texts.groupBy("doc", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    rows = materialize(texts.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")), "toxicity-sample")
    if (rows.agg(F.sum("size")).first()[0] or 0) > sample_bytes:
        room = Window.orderBy("size", F.xxhash64("doc"), "doc", "y")
        sizes = rows.select("doc", "y", "size").withColumn("upto", F.sum("size").over(room))          # at most two classes of the sample
        rows = rows.join(sizes.where(F.col("upto") <= sample_bytes).select("doc", "y"), ["doc", "y"])
    rows = rows.select("doc", "y", "text")

    def extract(batches):
        for batch in batches:
            for lo, hi, data, offsets in slices(column(batch, "text")):
                row, f = features(data, offsets)
                own = lists(np.bincount(row, minlength=hi - lo), pa.array(f.astype(np.int32)))
                pairs = [swapped_sentences(t or "", terms) for t in column(batch, "text").slice(lo, hi - lo).to_pylist()]
                sides = []
                for side in (0, 1):
                    flat = pa.array([p[side] for many in pairs for p in many], pa.string())
                    parts = []
                    for _, _, d2, o2 in slices(flat):
                        r2, f2 = features(d2, o2)
                        parts.append(lists(np.bincount(r2, minlength=len(o2) - 1), pa.array(f2.astype(np.int32))))
                    inner = pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))
                    sides.append(lists(np.array([len(many) for many in pairs], np.int64), inner))
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc").slice(lo, hi - lo), column(batch, "y").slice(lo, hi - lo), own, *sides],
                    names=["doc", "y", "f", "a", "c"])
    kind = docs.schema[doc_id].dataType.simpleString()
    got = rows.mapInArrow(extract, f"doc {kind}, y int, f array<int>, a array<array<int>>, c array<array<int>>").toArrow()
    # an order that does not depend on how the rows came in
    got = got.append_column("n", pc.list_value_length(got.column("f"))).sort_by(
        [("doc", "ascending"), ("y", "ascending"), ("n", "ascending")])
    y = got.column("y").to_numpy().astype(np.float64)
    if not len(y):
        return ToxicityModel(np.zeros(1 << FEATURE_BITS, np.float32), float(np.log(counts[1] / counts[0])))

    def csr(column_):
        array = column_.combine_chunks()
        size = pc.list_value_length(array).to_numpy()
        return np.r_[0, np.cumsum(size)].astype(np.int64), array.flatten().to_numpy()
    pairs = []
    for side in ("a", "c"):
        flat = got.column(side).combine_chunks().flatten()
        pairs += [*csr(pa.chunked_array([flat]))]
    return fit_rows(*csr(got.column("f")), y, pairs)


def score(docs: DataFrame, model: ToxicityModel, *, text: str = "text", to: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``to``: the probability that the text is toxic; null and empty texts get the bias alone.

    A column of that name is replaced.
    """
    table = docs.sparkSession.sparkContext.broadcast(model.weights)
    bias = model.bias

    def run(batches):
        w = table.value.astype(np.float64)
        for batch in batches:
            for lo, hi, data, offsets in slices(column(batch, text)):
                row, f = features(data, offsets)
                z = np.bincount(row, w[f], hi - lo) + bias
                p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
                yield pa.RecordBatch.from_arrays([c.slice(lo, hi - lo) for c in batch.columns] + [pa.array(p)],
                                                 names=[*batch.schema.names, to])
    docs = docs.drop(to)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(to, T.DoubleType())]))
