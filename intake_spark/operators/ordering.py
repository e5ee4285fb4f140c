"""Global ordering helpers: FIFO positions (W3) and top-k (O3).

A global ``row_number()`` window moves every row into one task. Instead the
rows are range-partitioned on the order key (balanced by sampling), sorted
within partitions and written to the shared checkpoint folder (so positions
are computed from one fixed materialisation and survive executor loss). Each
partition's row count gives its offset; the offsets table has one row per
partition - a proven bound - and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id above, row index below


def row_number_within(df: DataFrame, part_cols: list[str], order_cols: list[str], name: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based row number per ``part_cols`` group in ``order_cols`` order (order must be total).

    Skew-safe: rows are range-partitioned on (group, order), so a large group
    spans several tasks. Offsets come from a table with one row per
    (range partition, group) - at most ``num_partitions`` rows for any one
    group - and a window over it that is therefore bounded per group.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*part_cols, *order_cols]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    fixed = ranged.checkpoint(eager=True)
    ided = (fixed.withColumn("_mid", F.monotonically_increasing_id())
            .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
            .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))))
    counts = ided.groupBy("_pid", *part_cols).agg(F.count(F.lit(1)).alias("_n"), F.min("_loc").alias("_lo"))
    w = Window.partitionBy(*part_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *part_cols, "_lo", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    if not part_cols:
        offsets = F.broadcast(offsets)  # one row per range partition: a proven bound
    out = ided.join(offsets, ["_pid", *part_cols])
    return out.withColumn(name, (F.col("_off") + F.col("_loc") - F.col("_lo") + 1).cast("bigint")) \
        .drop("_mid", "_pid", "_loc", "_off", "_lo")


def global_row_number(df: DataFrame, order_cols: list[str], name: str = "position",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in ``order_cols`` order (order must be total)."""
    return row_number_within(df, [], order_cols, name, num_partitions)


def top_k(df: DataFrame, order_cols: list[str], k: int, name: str = "position") -> DataFrame:
    """O3: the first ``k`` rows in order (TakeOrderedAndProject: k rows per task, then merged)."""
    if k <= 0:
        return df.limit(0).withColumn(name, F.lit(None).cast("bigint"))
    head = df.orderBy(*order_cols).limit(k)
    return head.withColumn(name, F.row_number().over(Window.orderBy(*order_cols)).cast("bigint"))
