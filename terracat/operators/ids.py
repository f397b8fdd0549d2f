"""Dense surrogate ids 1..n without moving all rows to one partition.

``row_number() over (order by k)`` is exact but gathers every row in a single
task.  Instead we

1. range-partition on the (unique) order key and sort inside each partition,
2. tag each row with its partition id and its position inside the partition
   (``monotonically_increasing_id`` keeps the position in its low 33 bits),
3. count rows per partition (one row per partition), turn the counts into
   running offsets with a window over those few rows, and
4. join the offsets back (broadcast: one row per partition, bounded by the
   partition count, not by the data).

Steps 3 and 4 must see the very same shuffle output: Spark seeds the range
sampler with the RDD id, so two evaluations of one range repartition (one
for the counts, one for the rows, e.g. after column pruning made their
exchanges differ) can pick different bounds.  The tagged rows are
therefore written once, as Parquet in the folder named by
``spark.checkpoint.dir``, before the counts are taken; the counts and the
ids are both read from those files, which also survive the loss of an
executor.  Partition id and position are stored as columns, so the file
layout does not matter, and the count pass reads only the partition id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import materialize

_PID = "__tc_pid"
_POS = "__tc_pos"
_OFF = "__tc_off"
_CNT = "__tc_cnt"
_TIE = "__tc_tie"


def _order_cols(order_by) -> list[Column]:
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def dense_id(df: DataFrame, order_by, name: str, start: int | Column = 1,
             num_partitions: int | None = None, unique: bool = False) -> DataFrame:
    """Append ``name`` = start, start+1, ... in ``order_by`` order.

    ``order_by`` should be a total order (unique key) for the numbering to
    be reproducible across runs.  Ties are broken by a per-row tag that is
    stable under task retries, which also lets the range partitioner split
    a key shared by many rows (e.g. a group of copies holding a third of
    the input) over several tasks.  ``unique`` says that no two rows have equal
    keys (the primary-key rule checks it) and saves the tag and its sort.
    ``start`` may be a literal or a one-value Column expression such as a
    scalar subquery result.
    """
    keys = _order_cols(order_by)
    spark = df.sparkSession
    # Tie-breaker: position inside the input partition after a local sort by
    # a hash of the whole row.  Rows of a partition may arrive in any order
    # (e.g. after a shuffle) and a retried task must route every row as the
    # first attempt did; after the sort, only identical rows can swap places,
    # and those are interchangeable.  No shuffle is involved.
    tagged = df
    if not unique:
        hashable = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
        tagged = (df.sortWithinPartitions(F.xxhash64(*hashable))
                  .withColumn(_TIE, F.monotonically_increasing_id()))
        keys = [*keys, F.col(_TIE)]
    # Without an explicit count, AQE sizes the range partitions from the data
    # (coalescing keeps neighbouring ranges together, so order is preserved).
    ranged = (tagged.repartitionByRange(*([num_partitions] if num_partitions else []), *keys)
              .sortWithinPartitions(*keys)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    # Written once as Parquet in the shared checkpoint folder: the counts and
    # the ids below both read these files (the count pass reads one column).
    ranged = materialize(ranged, "dense_id")
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    # Window over one row per partition: bounded by n, never by the data.
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_CNT).over(w), F.lit(0)).alias(_OFF))
    start_c = start if isinstance(start, Column) else F.lit(start)
    out = (ranged.join(F.broadcast(offsets), _PID)
           .withColumn(name, (start_c.cast("long") + F.col(_OFF) + F.col(_POS)).cast("long"))
           .drop(_PID, _POS, _OFF, _TIE))
    return out


def dense_id_single(df: DataFrame, order_by, name: str, start: int = 1) -> DataFrame:
    """Reference form (one global window); only for tests and tiny inputs."""
    keys = _order_cols(order_by)
    return df.withColumn(name, (F.row_number().over(Window.orderBy(*keys)) + (start - 1)).cast("long"))
