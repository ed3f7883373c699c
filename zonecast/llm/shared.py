"""Shared-storage helpers: lineage is cut with written tables, never with executor-local state."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; it is deleted when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`shared_path` once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    A lost executor then costs a re-read of files that every node sees, not a
    recomputation, and branches that start from the result share one scan
    with column pruning.
    """
    return written(df, name)[0]


BROADCAST_BYTES = 16 << 20


def bounded(small: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written table marked for broadcast if its values measure at most ``limit`` bytes.

    Beyond that there is no hint: Spark joins by a shuffle, whose exchanges it
    can split at a hot key.
    """
    def width(f):
        if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.lit(8)
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(f.name), F.lit(0)) + 8
        return F.octet_length(F.to_json(F.struct(f.name)))
    size = F.lit(0)
    for f in small.schema.fields:
        size = size + width(f)
    total = small.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(small) if total <= limit else small


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """:func:`materialize`, with the path, for tables that are dropped before the session ends."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python tasks can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="zonecast-ship-")) / "zonecast_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
