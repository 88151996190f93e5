"""Dense surrogate keys: ``ROW_NUMBER() OVER (ORDER BY business key)`` that scales.

A window with no partition sends every row to one task. Here the rows are
range-partitioned by the order key, sorted, and that layout is checkpointed (the range
bounds come from sampling, so they must be fixed before being used twice). Rows are counted
per range partition, the counts become offsets (one row per partition, so the
broadcast is bounded by the partition count) and rows are numbered by their place in
their partition. The plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmart.session import ensure_checkpoint_dir


#: A monotonically increasing id holds the row's place in its partition in so many low bits.
PARTITION_SHIFT = 33


def _orders(order_cols: Sequence[str | Column]) -> list[Column]:
    # NULLs sort last, as in the SQL warehouse this mirrors.
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_cols]


def dense_key(df: DataFrame, order_cols: Sequence[str | Column], key_name: str,
              offset: Column | int = 0, partitions: int | None = None) -> DataFrame:
    """Add ``key_name`` = offset + 1..n in ``order_cols`` order (order must be total).

    One exchange: the rows are stored sorted inside their range partitions, so a row's place
    in its partition is its place in the stored file, which a monotonically increasing id
    counts, and the rows of the partitions before are a broadcast offset."""
    off = offset if isinstance(offset, Column) else F.lit(offset)
    orders, spark = _orders(order_cols), df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = df.repartitionByRange(n_parts, *orders).sortWithinPartitions(*orders).checkpoint(eager=True)
    place = F.monotonically_increasing_id()
    tagged = stored.withColumn("_place", place).withColumn("_pid", F.shiftright("_place", PARTITION_SHIFT))
    sizes = sorted(tuple(r) for r in tagged.groupBy("_pid").count().collect())    # one row per partition
    before, bases = 0, []
    for pid, n in sizes:
        bases.append((pid, before))
        before += n
    base = F.broadcast(spark.createDataFrame(bases, "_pid long, _base long"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << PARTITION_SHIFT) - 1))
    return tagged.join(base, "_pid").withColumn(key_name, (F.col("_base") + inside + 1 + off).cast("long")).drop(
        "_pid", "_place", "_base")


def cumulative_count(df: DataFrame, group: str | Sequence[str], order_cols: Sequence[str], weight: str,
                     out: str, partitions: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over the rows before this one inside its ``group``
    (ordered by ``order_cols``, which must be unique within the group).

    The weighted version of the numbering above: checkpointed range layout, per-partition
    totals turned into offsets, running sums inside partitions. One large group is spread
    over many tasks; only ``group`` totals (one row per group) are broadcast.
    """
    groups = [group] if isinstance(group, str) else list(group)
    keys = [*groups, *order_cols]
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = _orders(keys)
    tagged = df.repartitionByRange(n_parts, *orders).checkpoint(eager=True).withColumn(
        "_pid", F.spark_partition_id())
    base = (tagged.groupBy("_pid").agg(F.sum(weight).alias("_w"))
                  .withColumn("_base", F.coalesce(F.sum("_w").over(
                      Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                  .select("_pid", "_base"))
    run = F.coalesce(F.sum(weight).over(Window.partitionBy("_pid").orderBy(*orders)
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    glob = tagged.join(F.broadcast(base), "_pid").withColumn("_g", F.col("_base") + run)
    first = glob.groupBy(*groups).agg(F.min("_g").alias("_g0"))      # one row per group
    return (glob.join(F.broadcast(first), groups)
                .withColumn(out, (F.col("_g") - F.col("_g0")).cast("long"))
                .drop("_pid", "_base", "_g", "_g0"))
