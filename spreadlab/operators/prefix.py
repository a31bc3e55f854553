"""Distributed ordered scans.

A running total over ``PARTITION BY key ORDER BY t`` puts a whole key into one
task.  When one key may hold a third of all rows that task does not finish, so
``running_sum`` computes the same numbers in two passes whose tasks are all
bounded:

1. cut every key into coarse ordered buckets (e.g. a time bucket) and total
   each (key, bucket) -- a partial aggregate, map-side combined;
2. prefix-sum those bucket totals per key (rows per key = number of buckets);
3. running sum inside (key, bucket) plus the bucket's offset.

Step 3 partitions by (key, bucket), the same partitioning the offset join
produces, so it adds no exchange of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, keys: list[str], order_cols: list[str],
                sums: dict[str, str], bucket: Column | None = None,
                n_buckets: int | None = None) -> DataFrame:
    """Add one running-sum column per ``sums`` entry (out_name -> input column).

    ``bucket`` must be monotone non-decreasing in ``order_cols`` within a key
    (e.g. a time bucket).  ``None`` uses range-partition buckets instead: rows
    are range partitioned on (keys, order) -- Spark samples the sort key, so a
    hot key or a burst of rows at one instant is split over many partitions --
    and the partition id is the bucket.  Every task is then bounded by about
    rows / n_buckets whatever the skew.  Results are exact (integer inputs give
    exact sums in any order)."""
    b = "_scan_bucket"
    if bucket is None:
        from ..session import checkpoint_dir
        spark = df.sparkSession
        n = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        checkpoint_dir(spark)
        # The partition id is only a valid bucket if every consumer sees the
        # same assignment: write it once (reliable checkpoint in the shared
        # folder) so the totals and the row pass read identical buckets.
        staged = (df.repartitionByRange(n, *keys, *order_cols)
                  .withColumn(b, F.spark_partition_id())
                  .checkpoint(eager=True))
    else:
        staged = df.withColumn(b, bucket)
    totals = staged.groupBy(*keys, b).agg(*[F.sum(src).alias(f"_tot_{out}") for out, src in sums.items()])
    w_prev = (Window.partitionBy(*keys).orderBy(b)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*keys, b, *[
        F.coalesce(F.sum(f"_tot_{out}").over(w_prev), F.lit(0)).alias(f"_off_{out}") for out in sums])
    joined = staged.join(offsets, on=[*keys, b], how="inner")
    w_in = (Window.partitionBy(*keys, b).orderBy(*order_cols)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = joined.withColumns({
        out: F.col(f"_off_{out}") + F.sum(src).over(w_in) for out, src in sums.items()})
    return out.drop(b, *[f"_off_{o}" for o in sums])
