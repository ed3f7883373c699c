"""Zone dimension scans.

The lookup CSV is read with a schema in the order of its own header (a fixed
schema together with ``header=True`` maps columns by position and silently
mis-assigns a re-ordered file).  ``N/A`` stays a real value; only an empty
field is null.  Lines that do not fit become a table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The lookup's columns in canonical order.
EXPECTED_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")


_CORRUPT = "_record"


def read_zone_lookup(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(zones, rejected)`` of a lookup CSV (a file, or a folder of them).

    The header line is read first, and the rest with a schema in its order: a
    schema in another order would be matched by position.  ``rejected`` has
    ``record`` and ``reason``: *malformed* for a line with another number of
    fields (the whole line), *id is no integer* and *no id* for what its id
    says.  Blanks around an id do not matter.  Columns beyond the expected
    ones are read and dropped.
    """
    try:
        names = spark.read.option("header", True).csv(path).columns
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(str(exc)) from exc
        raise
    missing = [c for c in EXPECTED_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"zone lookup missing required columns: {missing}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _CORRUPT)])
    raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _CORRUPT).option("columnPruning", False).csv(path))
    text = F.nullif(F.trim("LocationID"), F.lit(""))
    number = text.try_cast("bigint")
    reason = (F.when(F.col(_CORRUPT).isNotNull(), F.lit("malformed")).when(text.isNull(), F.lit("no id"))
              .when(number.isNull(), F.lit("id is no integer")))
    read = raw.select(number.alias("_id"), reason.alias("reason"), "*")
    zones = read.where(F.col("reason").isNull()).select(F.col("_id").alias("LocationID"), *EXPECTED_COLUMNS[1:])
    line = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]))
    return zones, read.where(F.col("reason").isNotNull()).select(F.coalesce(F.col(_CORRUPT), line).alias("record"), "reason")


def load_zone_lookup(spark: SparkSession, path: str, *, validate: bool = True) -> DataFrame:
    """Read a zone lookup CSV → ``LocationID BIGINT, Borough, Zone, service_zone``.

    With ``validate`` a line that does not fit raises ``ValueError`` at load
    time, as the lookup's consumers expect; without, and for lines without
    id, :func:`read_zone_lookup` tells what was left out.
    """
    zones, rejected = read_zone_lookup(spark, path)
    if validate:
        bad = rejected.where(F.col("reason") != "no id").limit(3).collect()
        if bad:
            raise ValueError(f"LocationID must be integer and lines complete: {[(r['record'], r['reason']) for r in bad]}")
    return zones


def zone_dim_from_tables(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zone dimension over the driver's star schema.

    ``s_suppkey`` is the zone id, the region name plays the borough, the
    supplier name the zone and the nation name the service zone.
    """
    return (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
                    .join(region, nation.n_regionkey == region.r_regionkey, "left")
                    .select(F.col("s_suppkey").cast("bigint").alias("LocationID"),
                            F.col("r_name").alias("Borough"),
                            F.col("s_name").alias("Zone"),
                            F.col("n_name").alias("service_zone")))
