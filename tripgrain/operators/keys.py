"""Deterministic surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripgrain.operators.joins import estimated_bytes
from tripgrain.session import freeze

# Below this estimate one sorted task numbers the rows; above it the numbering is distributed.
ONE_TASK_BYTES = 8 * 1024 * 1024

# Stop sequences fit below this, so instance key * span + sequence is unique at trip-stop grain.
SEQUENCE_SPAN = 1 << 20
NEGATIVE_SEQUENCES = 1 << 16


class DuplicateKeyError(ValueError):
    """A table that must be unique on its business key is not."""


def running_total(
    df: DataFrame, order_by: Sequence[str], weight: str, name: str,
    one_task_bytes: int = ONE_TASK_BYTES, size: int | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all rows that come before, in ``order_by`` order.

    ``order_by`` must be unique. Large inputs are range partitioned and stored, so that a recomputed
    task cannot move a boundary; each partition is summed alone and shifted by the total of the
    partitions before it. The only one-task step sees one row per partition.
    """
    before = Window.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    if (estimated_bytes(df) if size is None else size) <= one_task_bytes:
        return df.withColumn(name, F.coalesce(F.sum(weight).over(before), F.lit(0)))
    placed = freeze(
        df.repartitionByRange(*order_by).withColumn("_part", F.spark_partition_id())
    )
    totals = placed.groupBy("_part").agg(F.sum(weight).alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(F.broadcast(shifts), "_part")
        .withColumn(name, F.col("_shift") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .drop("_part", "_shift")
    )


def add_dense_key(
    df: DataFrame, order_by: Sequence[str], name: str, one_task_bytes: int = ONE_TASK_BYTES
) -> DataFrame:
    """Number the rows 1..n in ``order_by`` order (``order_by`` must be unique).

    Large inputs are range sorted once and stored; the row position inside its partition comes from
    the stored order, so there is no second shuffle and no window over the table.
    """
    if estimated_bytes(df) <= one_task_bytes:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order_by)).cast("long"))
    placed = freeze(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftrightunsigned("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"))
    position = F.col("_at").bitwiseAND((1 << 33) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(shifts), "_part")
        .withColumn(name, F.col("_shift") + position + 1)
        .drop("_part", "_shift", "_at")
    )


def add_key(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Integer surrogate key of a dimension; large dimensions take the distributed path."""
    return add_dense_key(df, order_by, name).withColumn(name, F.col(name).cast("int"))


def trip_stop_key(instance_key: str = "TripInstanceKey", sequence: str = "StopSequence"):
    """Key of a trip-stop, computed without numbering the largest table of the warehouse.

    A sequence outside ``SEQUENCE_SPAN`` numbers, of which ``NEGATIVE_SEQUENCES`` are below zero, would share
    keys with the next trip; it raises instead.
    """
    number = F.col(sequence)
    inside = number.isNull() | number.between(-NEGATIVE_SEQUENCES, SEQUENCE_SPAN - NEGATIVE_SEQUENCES - 1)
    wrong = F.raise_error(F.concat(F.lit("stop sequence without a key of its own: "), number.cast("string"))).cast("bigint")
    return F.when(inside, F.col(instance_key) * SEQUENCE_SPAN + number).otherwise(wrong)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with ``DuplicateCount``."""
    return df.groupBy(*keys).agg(F.count("*").alias("DuplicateCount")).filter("DuplicateCount > 1")


def require_unique(df: DataFrame, keys: Sequence[str], table: str = "table") -> DataFrame:
    """Return ``df`` unchanged, or raise when a key repeats."""
    repeated = duplicates(df, keys).limit(5).collect()
    if repeated:
        raise DuplicateKeyError(f"{table} repeats {list(keys)}: {[tuple(r) for r in repeated]}")
    return df
