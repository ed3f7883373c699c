"""Global positions in a sort order, without a single-task window."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.shared import bounded, materialize


def with_position(df: DataFrame, *keys: str, name: str) -> DataFrame:
    """``df`` written with a long column ``pos``: 0, 1, 2, ... in the order of ``keys``.

    Rows are range-partitioned and sorted within partitions; a partition's
    offset is the number of rows in those before it (one row per partition
    goes through the running sum).  Rows equal in all keys come in any order.
    """
    def number(batches):
        n = 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(n, n + batch.num_rows))], names=[*batch.schema.names, "_n"])
            n += batch.num_rows
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(number, f"{kinds}, _n long")
    ranged = materialize(ranged.withColumn("_part", F.spark_partition_id()), name)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(sizes.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows"), name)
    return ranged.join(bounded(offsets), "_part").withColumn("pos", F.col("_offset") + F.col("_n")).drop("_part", "_offset", "_n")
