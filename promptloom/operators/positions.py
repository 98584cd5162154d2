"""Exact positions and fixed-size batches without sending a large group to one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promptloom.storage import materialise

ROWS_PER_TASK = 250_000


def number_rows(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (), name: str = "position",
                rows_per_task: int = ROWS_PER_TASK, total: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in the order of ``order_by`` within ``partition_by``.

    Counts the rows first (pass ``total`` to skip that). They are range-partitioned into slices of at most about
    ``rows_per_task`` rows, as many as there are cores at the least, numbered within each slice and
    shifted by the number of rows in the slices before, so a group of any size spreads over many tasks.
    ``order_by`` should be unique within a group.
    """
    if total is None:
        total = df.count()
    keys, order = list(partition_by), list(order_by)
    slices = max(-(-total // rows_per_task), df.sparkSession.sparkContext.defaultParallelism)
    # The slice number depends on the task that computed it, so it is stored before it is used twice.
    sliced = materialise(
        df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"))
    # At most one row per slice and group boundary: a group meets only the slices it spans.
    before = _window(keys, ["_slice"]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col("_slice").alias("_o_slice"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    local = sliced.withColumn("_local", F.row_number().over(_window([*keys, "_slice"], order)))
    on = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys],
        F.col("_slice") == F.col("_o_slice"),
    )
    return local.join(offsets, on).select(*df.columns, (F.col("_local") + F.col("_before")).alias(name))


def _window(keys: Sequence[str], order: Sequence[str]):
    by_order = [F.col(c) for c in order]
    return Window.partitionBy(*keys).orderBy(*by_order) if keys else Window.orderBy(*by_order)


def assign_batches(df: DataFrame, size: int, order_by: Sequence[str], partition_by: Sequence[str] = (),
                   name: str = "batch", **options) -> DataFrame:
    """Number batches of ``size`` consecutive rows from 0 within each group."""
    numbered = number_rows(df, order_by, partition_by, "_position", **options)
    return numbered.withColumn(name, F.expr(f"(_position - 1) div {int(size)}")).drop("_position")


def batch_budget(df: DataFrame, size: int, prompt: str, order_by: Sequence[str], partition_by: Sequence[str] = (),
                 max_new_tokens: int = 0, name: str = "batch", **options) -> DataFrame:
    """Token need of each batch of ``size`` prompts: that of its longest one. Only lengths are shuffled."""
    lengths = df.select(*partition_by, *order_by, F.length(prompt).alias("_length"))
    longest = F.max("_length")
    return assign_batches(lengths, size, order_by, partition_by, name, **options).groupBy(*partition_by, name).agg(
        F.count("*").alias("n_prompts"), (F.ceil(longest / 4) + max_new_tokens).cast("long").alias("max_tokens")
    )
