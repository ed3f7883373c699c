"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed 60-bit hash.  A source's share is a whole number of
passes over it plus the documents whose hash is below a cut; the cut is found
from sums of sizes by source and hash bucket, refining only the bucket in
which the budget ends, 12 bits at a time.  Selecting is then a filter: nothing
is sorted, reruns agree, and a smaller budget's documents are a subset of a
larger one's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.shared import bounded, materialize

HASH_BITS = 60
STEP_BITS = 12
WEIGHTS = (3, 1, 2)


def hash60(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of the MD5 of ``<doc_id>:<text>``."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sized(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``_size``, ``_hash`` and the null-safe source key ``_source_null``, ``_source``."""
    return docs.withColumns({
        "_size": word_count(F.col(text)), "_hash": hash60(F.col(doc_id), F.col(text)),
        "_source_null": F.col(source).isNull(), "_source": F.coalesce(F.col(source).cast("string"), F.lit(""))})


_KEY = ["_source_null", "_source"]


def targets(sources: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """One row per source with its target.

    Sources, by code point with null last, take the weights in turn and share
    ``share`` times all sizes by weight.  A target stops at twice the source's
    size and the excess goes to the others by weight until none is above:
    every target is ``min(2 * size, level * weight)``, and the level follows
    from running sums over the sources by ``2 * size / weight``.  The windows
    run over one row per source.
    """
    name = Window.orderBy(*_KEY)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(name) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumn("weight", w).withColumn("cap", 2 * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), *_KEY)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    total = Window.partitionBy()
    rows = rows.withColumns({
        "rank": F.row_number().over(order),
        "level": (share * F.sum("source_size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)})
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("rank", "level"))
    rows = rows.withColumn("level", F.min(fits).over(total)["level"])
    target = F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.col("cap").cast("double"))
    return rows.select(*_KEY, "source_size", target.alias("target"))


def cuts(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5) -> DataFrame:
    """``source_size``, ``target``, ``passes`` and ``cut`` of every source of a :func:`sized` table.

    A document is taken ``passes`` times, and once more if its hash is below
    ``cut``.  The document on the cut is in if that is nearer the target.
    """
    sources = docs.groupBy(*_KEY).agg(F.sum("_size").alias("source_size"))
    state = targets(sources, weights, share)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = state.withColumn("passes", passes).withColumns({
        "rest": F.col("target") - F.col("passes") * F.col("source_size"), "lo": F.lit(0).cast("long"), "spent": F.lit(0).cast("long")})
    state = materialize(state, "mix-state")
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        open_ = state.where("source_size > 0").select(*_KEY, "rest", "spent", F.shiftright("lo", shift + STEP_BITS).alias("prefix"))
        inside = docs.select(*_KEY, "_size", F.shiftright("_hash", shift).alias("bucket")).join(bounded(open_), _KEY).where(
            F.shiftright("bucket", STEP_BITS) == F.col("prefix"))
        sums = inside.groupBy(*_KEY, "bucket").agg(F.sum("_size").alias("n"), F.first("rest").alias("rest"), F.first("spent").alias("spent"))
        upto = Window.partitionBy(*_KEY).orderBy("bucket")       # at most 2 ** STEP_BITS rows a source
        sums = sums.withColumn("spent", F.col("spent") + F.sum("n").over(upto))
        ends = sums.where(F.col("spent") > F.col("rest")).groupBy(*_KEY).agg(
            F.min(F.struct("bucket", "n", "spent")).alias("end"))
        state = state.drop("lo", "spent", "over").join(ends, _KEY, "left").select(
            *_KEY, "source_size", "target", "passes", "rest",
            F.coalesce(F.shiftleft("end.bucket", shift), F.lit(0)).alias("lo"),
            F.coalesce(F.col("end.spent") - F.col("end.n"), F.lit(0)).alias("spent"),
            F.coalesce("end.n", F.lit(0)).alias("over"))
        state = materialize(state, "mix-state")
    nearer = F.col("spent") + F.col("over") - F.col("rest") < F.col("rest") - F.col("spent")
    return state.select(*_KEY, "source_size", "target", "passes", (F.col("lo") + nearer.cast("long")).alias("cut"))


def take(docs: DataFrame, state: DataFrame) -> DataFrame:
    """A :func:`sized` table with size, source_size, target and taken, in words."""
    copies = F.col("passes") + (F.col("_hash") < F.col("cut")).cast("long")
    return docs.join(bounded(state), _KEY).withColumns(
        {"size": F.col("_size"), "taken": F.col("_size") * copies}).drop("passes", "cut", "_size", "_hash", *_KEY)


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, columns: list[str] | None = None) -> DataFrame:
    """``docs`` with size, source_size, target (its source's) and taken, all in words.

    A null or empty text has size 0 and is taken 0 times as many words; a null
    source is a source of its own.  Rows equal in id and text are taken alike.
    Columns of those names (and ``_``-prefixed helpers) in ``docs`` are
    replaced; an empty table gives an empty result.  ``columns`` limits what
    of ``docs`` is returned.
    """
    made = {"size", "source_size", "target", "taken", "_size", "_hash", *_KEY} - {doc_id, text, source}
    docs = docs.drop(*made)
    if columns is None:
        columns = docs.columns
    narrow = sized(docs, doc_id=doc_id, text=text, source=source)
    # the sizes and hashes are computed once; the text only goes along if it is asked for
    plain = [c for c in columns if c != text]
    kept = materialize(narrow.select(*plain, "_size", "_hash", *_KEY), "mix-sizes")
    state = cuts(kept, weights=weights, share=share)
    out = take(kept if text not in columns else narrow.select(*columns, "_size", "_hash", *_KEY), state)
    return out.select(*columns, "size", "source_size", "target", "taken")
