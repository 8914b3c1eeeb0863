"""Running totals that do not put a hot key into one task.

A plain ``sum().over(partitionBy(key).orderBy(...))`` sends every row of a key
to one task. Here the order is split into a *bucket* prefix (e.g. minute,
second) and a tail (e.g. event_order):

1. local running sum/count inside each (key, bucket), partitioned by the
   bucket, so a hot key is spread over all of its buckets;
2. the last row of each (key, bucket) holds the bucket's totals; an exclusive
   prefix sum of these rows per key is a window over bucket-sized rows only;
3. the prefix is joined back on (key, bucket) and added. Key and bucket form one
   struct column, never NULL itself, whose NULL fields are equal to each other:
   a plain ``=`` join on it reuses the partitioning of step 1. Both sides stand on
   the same exchange, so that rows of no other columns than those of the order
   and the value are read and shuffled once.

The result equals the one-window form for any data (``tests/test_properties.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def running_total(df: DataFrame, keys: Sequence[str], buckets: Sequence[str],
                  tail: Sequence[str], value: str, out: str,
                  position: str | None = None) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per ``keys`` in (buckets, tail) order.

    NULL values are skipped in the sum (the running total carries over).
    ``position`` (optional) = 1-based row position in that order. Ascending
    order, NULLs last. Built as one SQL statement over ``df`` (one analysis).
    """
    keys, buckets, tail = list(keys), list(buckets), list(tail)
    cols = ", ".join(f"l.{_q(c)}" for c in df.columns)
    v = _q(value)
    sql = f"""
    WITH keyed AS (
      SELECT *, struct({", ".join(map(_q, keys + buckets))}) AS _part FROM {{src}}),
    local AS (
      SELECT *, sum({v}) OVER wl AS _local_sum, count(1) OVER wl AS _local_n,
             lead(1) OVER wt IS NULL AS _last
      FROM keyed
      WINDOW wt AS (PARTITION BY _part ORDER BY {", ".join(_q(c) + " ASC NULLS LAST" for c in tail)}),
             wl AS (PARTITION BY _part ORDER BY {", ".join(_q(c) + " ASC NULLS LAST" for c in tail)}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    offsets AS (
      SELECT _part, sum(_local_sum) OVER wb AS _off_sum, sum(_local_n) OVER wb AS _off_n
      FROM local WHERE _last
      WINDOW wb AS (PARTITION BY {", ".join(map(_q, keys))}
                    ORDER BY {", ".join(_q(c) + " ASC NULLS LAST" for c in buckets)}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT {cols},
           CASE WHEN l._local_sum IS NOT NULL OR o._off_sum IS NOT NULL
                THEN coalesce(o._off_sum, 0D) + coalesce(l._local_sum, 0D) END AS {_q(out)},
           coalesce(o._off_n, 0L) + l._local_n AS _position
    FROM local l LEFT JOIN offsets o ON l._part = o._part"""
    result = df.sparkSession.sql(sql, src=df)
    if position:
        return result.withColumnRenamed("_position", position)
    return result.drop("_position")


def running_total_single_window(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                                value: str, out: str) -> DataFrame:
    """Reference form (one window per key) used by tests to check ``running_total``."""
    w = (Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.sum(value).over(w))
