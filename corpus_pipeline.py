"""The training-corpus pipeline: five operators of ``zonecast.llm`` over the documents, one after the other.

Every stage takes what its predecessor kept, written as Parquet and read
again.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import toxicity
from zonecast.llm.decontaminate import drop_contaminated
from zonecast.llm.mixing import mix
from zonecast.llm.near_dup import drop_near_duplicates
from zonecast.llm.queries import label_fold, table
from zonecast.llm.shared import materialize, ship_package
from zonecast.llm.suffix_dedup import remove_repeats


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half.

    It is fitted to the labelled rows of the whole documents table, without
    the held-out fifth.
    """
    ship_package(spark)
    labels = table(spark, sf_dir, "labels").where(label_fold("doc_id") != 0)
    model = toxicity.fit(table(spark, sf_dir, "documents"), labels)
    return toxicity.score(docs, model, to="_toxicity").where(F.col("_toxicity") < 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates (five-word shingles, similarity 0.8)."""
    ship_package(spark)
    return drop_near_duplicates(docs)


# Fifty words of natural text rarely have fewer bytes than this.
PASSAGE_BYTES = 240


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without the characters of any string of ``PASSAGE_BYTES`` bytes that stood earlier.

    The first occurrence (smallest id, then position) stays.  ``n_chars`` is
    counted anew; a null text stays null; other columns pass unchanged,
    whatever their names.
    """
    ship_package(spark)
    columns = docs.columns
    whole = docs.select("doc_id", "text", F.struct(*[docs[c] for c in columns]).alias("row"))
    found = remove_repeats(whole, length=PASSAGE_BYTES, whole_characters=True, keep_first=True, keep=("row",))
    text = F.when(F.col("row.text").isNotNull(), F.col("kept").cast("string"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten consecutive words (nor a whole shorter item) with the benchmark."""
    ship_package(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target and taken (words, repeats counted)."""
    ship_package(spark)
    return mix(docs).where("taken > 0")


STAGES = [
    ("toxicity", reject_toxic),
    ("near-duplicates", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

# The classifier and the mix's hashes of shortened texts are not SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
