"""Skew-safe "last value before this row" per key.

``lag`` over ``Window.partitionBy(key)`` sends every row of a key to one task;
one hot key holding a third of the data would then be sorted by a single
task.  ``last_before`` splits each key into order-range buckets of bounded
width instead:

1. inside each ``(key, bucket)`` a window gives the last value seen earlier
   in the same bucket (groups are bounded by the bucket width);
2. a per-``(key, bucket)`` summary (last value of the bucket, a partial
   aggregate over the key/order/value columns only) is carried forward
   across buckets with a window over the summaries — one row per bucket,
   tiny next to the data;
3. the two are combined with a join on ``(key, bucket)``, which reuses the
   partitioning of step 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_run_dir


def last_before(df: DataFrame, keys: list[str], order: str, value: Column | str,
                out: str, bucket_width: int = 1 << 16, levels: int = 1) -> DataFrame:
    """Add column ``out``: the last non-null ``value`` among rows with the
    same ``keys`` and a strictly smaller ``order`` (ties: none counted).

    ``order`` is an integral column (a sequence number) or a timestamp (taken
    as epoch microseconds); ``bucket_width`` bounds the rows any one window
    group holds for a key with unique order values.  ``levels`` above 1 carries
    the bucket summaries in buckets of their own, for orders whose buckets are
    so narrow that a hot key has very many (time, three levels).
    """
    val = F.col(value) if isinstance(value, str) else value
    b = "__bucket"
    v = "__val"
    if dict(df.dtypes).get(order, "").startswith("timestamp"):
        # time order: bucket and compare on epoch microseconds
        df = df.withColumn("__order", F.unix_micros(F.col(order).cast("timestamp")))
        out_df = last_before(df, keys, "__order", val, out, bucket_width, levels=3)
        return out_df.drop("__order")
    d = df.withColumn(b, F.floor(F.col(order) / F.lit(bucket_width))).withColumn(v, val)

    # Bucket summaries come from the raw rows with a partial aggregate: the
    # branch reads only the key, order and value columns, and each map task
    # ships one row per (key, bucket), so its shuffle is tiny.
    summary = (d.groupBy(*keys, b)
               .agg(F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(order))).alias("__last")))
    w_in = (Window.partitionBy(*keys, b).orderBy(order)
            .rangeBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("__prev_in", F.last(v, ignorenulls=True).over(w_in))
    if levels > 1:
        named = summary.select(*keys, F.col(b).alias("__at"), "__last")
        summary = last_before(named, keys, "__at", "__last", "__above", 1 << 12, levels - 1) \
            .select(*[F.col(k).alias(f"__s_{k}") for k in keys], F.col("__at").alias("__s_b"), F.col("__above").alias("__carry"))
    else:
        w_b = (Window.partitionBy(*keys).orderBy(b)
               .rowsBetween(Window.unboundedPreceding, -1))
        summary = summary.select(*[F.col(k).alias(f"__s_{k}") for k in keys], F.col(b).alias("__s_b"),
                                 F.last("__last", ignorenulls=True).over(w_b).alias("__carry"))

    # Null-safe equality: NULL keys form one group, as in a window.
    cond = [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys] + [F.col(b) == F.col("__s_b")]
    return (d.join(summary, on=cond, how="left")
            .withColumn(out, F.coalesce(F.col("__prev_in"), F.col("__carry")))
            .drop(b, v, "__prev_in", "__carry", "__s_b", *[f"__s_{k}" for k in keys]))


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with ``out``, the 0-based place of each row in the order of ``order``.

    Rows are sorted within range partitions and written once with their place in
    the partition; one count per partition, a few rows however many there are,
    turns that into the place in the whole order.  No task sees more than its
    range, unlike a window without keys.
    """
    spark, folder = df.sparkSession, new_run_dir(df.sparkSession, "numbered")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
       .withColumn(out, F.monotonically_increasing_id()).write.parquet(folder))
    rows = spark.read.parquet(folder)
    part, within = F.shiftright(out, 33), F.col(out).bitwiseAND(F.lit((1 << 33) - 1))
    counts = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    # as many rows as there are range partitions
    return (rows.withColumn("__part", part).join(F.broadcast(before), "__part")
            .withColumn(out, within + F.col("__before")).drop("__part", "__before"))
