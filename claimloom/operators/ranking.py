"""Places in an order that no single task sees whole: over a table, inside groups, and in segments of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators.saving import saved


def grouped_rank(rows: DataFrame, groups: list[str], by: list[Column], out: str = "rank") -> DataFrame:
    """Places from 0 inside each group (null is a group too), in the order of ``by``.

    Rows are range-partitioned by group and order, counted by group and partition, and ranked inside their partition; the
    counts of the partitions before are added. A group of all rows is spread over all tasks. The partitioned rows are
    saved, as another evaluation could draw other bounds.
    """
    parts = saved(rows.repartitionByRange(*[F.col(g).asc() for g in groups], *by).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_count"))
    before = F.sum("_count").over(Window.partitionBy(*groups).orderBy("_part")) - F.col("_count")
    firsts = counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_part").alias("_p"), before.alias("_before"))
    ranked = parts.withColumn("_rank", F.row_number().over(Window.partitionBy(*groups, "_part").orderBy(*by)))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = ranked.join(firsts if groups else F.broadcast(firsts), same)
    return joined.withColumn(out, (F.col("_before") + F.col("_rank") - 1).cast("long")).select(*rows.columns, out)


def global_rank(rows: DataFrame, *by: str, out: str = "rank") -> DataFrame:
    """Places from 0 over the whole table."""
    return grouped_rank(rows, [], [F.col(c).asc() for c in by], out)


def segments(rows: DataFrame, group: str, item: str, size: int) -> DataFrame:
    """(group, segment, items): the sorted items of each group, repeats kept, in lists of at most ``size``."""
    ranked = grouped_rank(rows.select(group, item), [group], [F.col(item).asc()], "_place")
    each = ranked.groupBy(group, F.floor(F.col("_place") / size).cast("long").alias("segment"))
    return each.agg(F.array_sort(F.collect_list(item)).alias("items"))
