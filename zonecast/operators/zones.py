"""Zone labelling: dimension joins, labels, membership, borough roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.columns import require_columns
from zonecast.sources.zones import EXPECTED_COLUMNS


def one_row_per_id(dim: DataFrame, order: str | None = None) -> DataFrame:
    """Keep one row per ``LocationID`` so a join cannot multiply rows.

    With an ``order`` column the row with the largest value wins (the last
    one of a file when ``order`` is the read position); without it the
    largest label tuple wins, which is deterministic.
    """
    require_columns(dim, EXPECTED_COLUMNS, "zone lookup")
    payload = F.struct(*[F.col(c) for c in EXPECTED_COLUMNS[1:]])
    if order is None:
        pick = F.max(payload)
    else:
        pick = F.max_by(payload, F.col(order))
    return (dim.where(F.col("LocationID").isNotNull())
               .groupBy("LocationID").agg(pick.alias("_p"))
               .select("LocationID", *[F.col(f"_p.{c}").alias(c) for c in EXPECTED_COLUMNS[1:]]))


class ZoneResolver:
    """A zone dimension with one row per id, ready to join.

    Joins carry no hint: adaptive execution broadcasts the dimension when its
    measured bytes are below the session's threshold, and otherwise splits a
    hot id's partition.
    """

    def __init__(self, dim: DataFrame, *, dedupe: bool = True):
        require_columns(dim, EXPECTED_COLUMNS, "zone lookup")
        self.dim = one_row_per_id(dim) if dedupe else dim.select(*EXPECTED_COLUMNS)

    def known_ids(self) -> DataFrame:
        """The valid ids (one ``LocationID`` column)."""
        return self.dim.select("LocationID")

    def annotate(self, df: DataFrame, id_column: str = "PULocationID", prefix: str = "PU") -> DataFrame:
        """Append ``{prefix}_borough, {prefix}_zone, {prefix}_service_zone``.

        Unknown or null ids get null labels; the row count never changes.
        Columns of those names are replaced.
        """
        require_columns(df, (id_column,), "DataFrame")
        df = df.drop(*[c for c in (f"{prefix}_borough", f"{prefix}_zone", f"{prefix}_service_zone") if c != id_column])
        key = f"_{prefix}_key"
        d = self.dim.select(F.col("LocationID").alias(key),
                                       F.col("Borough").alias(f"{prefix}_borough"),
                                       F.col("Zone").alias(f"{prefix}_zone"),
                                       F.col("service_zone").alias(f"{prefix}_service_zone"))
        return df.join(d, F.col(id_column).cast("bigint") == F.col(key), "left").drop(key)

    def label(self, df: DataFrame, id_column: str = "zone_id", out: str = "label") -> DataFrame:
        """Append ``zone {id} ({zone}, {borough})`` / ``zone {id} (unknown)``."""
        lab = self.annotate(df, id_column, "_lab")
        return lab.withColumn(out, zone_label(id_column, "_lab_zone", "_lab_borough")) \
                  .drop("_lab_borough", "_lab_zone", "_lab_service_zone")

    def known(self, df: DataFrame, id_column: str = "PULocationID") -> DataFrame:
        """Rows whose id is in the dimension (left semi join)."""
        d = self.dim.select(F.col("LocationID").alias("_k"))
        return df.join(d, F.col(id_column).cast("bigint") == F.col("_k"), "left_semi")

    def unresolved(self, df: DataFrame, id_column: str = "PULocationID") -> DataFrame:
        """Distinct ids missing from the dimension, with their row counts.

        Counting first (partial aggregation) keeps the join input at one row
        per id however many rows a hot id has.
        """
        counts = (df.where(F.col(id_column).isNotNull())
                    .groupBy(F.col(id_column).cast("bigint").alias("zone_id"))
                    .agg(F.count(F.lit(1)).alias("n_rows")))
        d = self.dim.select(F.col("LocationID").alias("_k"))
        return counts.join(d, F.col("zone_id") == F.col("_k"), "left_anti")


def annotate(df: DataFrame, dim: DataFrame, id_column: str = "PULocationID",
             prefix: str = "PU", *, dedupe: bool = True) -> DataFrame:
    """One-off :meth:`ZoneResolver.annotate`."""
    return ZoneResolver(dim, dedupe=dedupe).annotate(df, id_column, prefix)


def zone_label(zone_id: Column | str, zone: Column | str, borough: Column | str) -> Column:
    """``"zone {id} ({zone}, {borough})"``, or ``"zone {id} (unknown)"``."""
    zid = F.col(zone_id) if isinstance(zone_id, str) else zone_id
    z = F.col(zone) if isinstance(zone, str) else zone
    b = F.col(borough) if isinstance(borough, str) else borough
    return (F.when(z.isNull() | b.isNull(), F.format_string("zone %d (unknown)", zid.cast("bigint")))
             .otherwise(F.format_string("zone %d (%s, %s)", zid.cast("bigint"), z, b)))


def known_ids(df: DataFrame, dim: DataFrame, id_column: str = "PULocationID") -> DataFrame:
    return ZoneResolver(dim).known(df, id_column)


def unresolved_ids(df: DataFrame, dim: DataFrame, id_column: str = "PULocationID") -> DataFrame:
    return ZoneResolver(dim).unresolved(df, id_column)


def zones_without_demand(dim: DataFrame, trips: DataFrame, id_column: str = "PULocationID") -> DataFrame:
    """Dimension rows that no trip picks up from."""
    seen = trips.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("_k")).distinct()
    return one_row_per_id(dim).join(seen, F.col("LocationID") == F.col("_k"), "left_anti")


def borough_demand(panel: DataFrame, dim, *, key: str = "zone_id",
                   time: str = "hour", value: str = "demand") -> DataFrame:
    """Roll zone demand up to (borough, hour); unknown zones go to a null borough."""
    require_columns(panel, (key, time, value), "demand panel")
    resolver = dim if isinstance(dim, ZoneResolver) else ZoneResolver(dim)
    labelled = resolver.annotate(panel, key, "z")
    return (labelled.groupBy(F.col("z_borough").alias("borough"), time)
                    .agg(F.sum(value).cast("bigint").alias(value)))
