"""Row numbers within groups without sending a group to one task.

``row_number() over (partition by g order by o)`` puts every row of a group in
one task, so one hot group (a third of the data) would run on a single core.
Here the rows are range-partitioned on ``(g, o)``, so a hot group is split over
many tasks. Each task numbers its rows locally, and a small table of
per-partition counts gives every group the number of its rows in earlier
partitions. This generalises ``zipWithIndex`` to grouped numbering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.session import materialize

_PID, _POS, _N, _FIRST, _BEFORE = "_rn_pid", "_rn_pos", "_rn_n", "_rn_first", "_rn_before"


def number_rows(
    df: DataFrame,
    order_by: Sequence[Column],
    partition_by: Sequence[str] = (),
    *,
    name: str = "rn",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1, 2, 3, ... within each ``partition_by`` group in ``order_by`` order.

    ``order_by`` should make the order total (add a unique tie-break column),
    otherwise tied rows get their numbers in an arbitrary order.

    The range-partitioned rows are written once: partition ids and positions
    stay fixed if an executor is lost, and the counts read exactly the placement
    that is numbered. There is one row of counts per group and partition that
    holds it; they are written too, so that Spark knows how small they are and
    sends them to the rows where that is possible.
    """
    keys = [F.col(c) for c in partition_by]
    # Without an explicit count, AQE sizes the range exchange; coalesced
    # partitions are adjacent ranges, so the order across partitions holds.
    ranged = (
        df.repartitionByRange(partitions, *keys, *order_by) if partitions else df.repartitionByRange(*keys, *order_by)
    ).sortWithinPartitions(*keys, *order_by)
    placed = ranged.withColumn(_PID, F.spark_partition_id()).withColumn(_POS, F.monotonically_increasing_id())
    tagged = materialize(placed, "numbered-rows")
    counts = tagged.groupBy(_PID, *partition_by).agg(F.count(F.lit(1)).alias(_N), F.min(_POS).alias(_FIRST))
    counts = materialize(counts, "row-counts")
    group_keys = [f"_rn_g{i}" for i in range(len(partition_by))]
    # Without a group key this window sees one row per partition.
    earlier = Window.partitionBy(*partition_by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(_PID).alias("_rn_opid"),
        *[F.col(c).alias(g) for c, g in zip(partition_by, group_keys)],
        _FIRST,
        F.coalesce(F.sum(_N).over(earlier), F.lit(0)).alias(_BEFORE),
    )
    # Null-safe join keys: a null group key is a group of its own, as in a window.
    cond = [F.col(_PID) == F.col("_rn_opid")] + [
        F.col(c).eqNullSafe(F.col(g)) for c, g in zip(partition_by, group_keys)
    ]
    joined = tagged.join(offsets, cond, "inner")
    rn = (F.col(_POS) - F.col(_FIRST) + F.col(_BEFORE) + F.lit(1)).alias(name)
    return joined.select(*[F.col(c) for c in df.columns], rn)
