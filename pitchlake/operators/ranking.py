"""Places in a sorted order without a window over all rows.

The rows are range-partitioned and sorted by Spark, and each gets its partition
and its place there from one number (``monotonically_increasing_id`` over the
sorted partitions). The sorted rows are written once, so that counting and
numbering see the same partitions; counts per partition (one row each) become
offsets, and a row's place is its partition's offset plus its place there. A
place inside a group is the place minus that of the group's first row. No task
holds more than its range of the order, however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.session import scratch_lake

#: Spark's ids hold the partition above these bits, the place in it below.
_PLACE_BITS = 33


def positions(df: DataFrame, order: Sequence[str], out: str = "position", within: Sequence[str] = ()) -> DataFrame:
    """``df`` with the 1-based place ``out`` (int) of every row in ascending ``order`` (NULLs last), in
    each group of equal ``within`` columns if there are any (NULLs are equal there)."""
    spark, columns = df.sparkSession, df.columns
    ordered = df.orderBy(*[F.col(c).asc_nulls_last() for c in (*within, *order)])
    path = f"{scratch_lake(spark)}/sorted"
    ordered.withColumn("_spot", F.monotonically_increasing_id()).write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("_spot", T.LongType())])
    stored = spark.read.schema(schema).parquet(path).withColumn(
        "_part", F.shiftrightunsigned("_spot", _PLACE_BITS))
    # one row per partition of the sort, a bounded number
    counts = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    starts = [0, *accumulate(r["n"] for r in counts)]
    offsets = spark.createDataFrame([(r["_part"], s) for r, s in zip(counts, starts, strict=False)],
                                    "_part long, _start long")
    place = F.col("_start") + F.col("_spot").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1
    placed = stored.join(F.broadcast(offsets), "_part").withColumn("_place", place)
    if not within:
        return placed.select(*columns, F.col("_place").cast("int").alias(out))
    group = F.struct(*[F.col(c) for c in within])
    first = placed.groupBy(group.alias("_group")).agg(F.min("_place").alias("_first"))
    return placed.withColumn("_group", group).join(first, "_group").select(
        *columns, (F.col("_place") - F.col("_first") + 1).cast("int").alias(out))
