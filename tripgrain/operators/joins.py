"""Joins of a large table with a lookup table, safe for hot keys.

No size is assumed: the broadcast decision uses Catalyst's own estimate of the lookup side. Above
the broadcast limit the join shuffles, and keys that hold many rows are split into pieces.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that one task may take before the key is split.
HOT_ROWS = 2_000_000

UNKNOWN_SIZE = 1 << 62


# Stored columns are compressed, and the estimate of a stored table is the size of its files.
_UNPACKED = 4


def _catalyst_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def estimated_bytes(df: DataFrame) -> int:
    """Size in memory from Catalyst's estimate: near for stored tables, far too high after joins."""
    return _catalyst_bytes(df) * _UNPACKED


def broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    if text.startswith("-"):  # broadcasting is switched off
        return -1
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def hot_keys(rows: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the ``_pieces`` to cut them into.

    At most total / hot_rows keys are hot, which bounds the size of the result.
    """
    counted = rows.groupBy(*on).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot_rows)
    return counted.select(*on, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_pieces"))


def _pieces():
    return F.coalesce(F.col("_pieces"), F.lit(1))


def mark_pieces(big: DataFrame, hot: DataFrame, on: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Add ``_piece``, which cuts the rows of hot keys by the values of ``spread_by``."""
    named = hot.select(*(F.col(k).alias(f"_hot_{k}") for k in on), "_pieces")
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in on))  # NULL may be the largest key
    marked = big.join(F.broadcast(named), same, "left")
    piece = F.pmod(F.xxhash64(*spread_by), _pieces()).cast("int")
    return marked.withColumn("_piece", piece).drop("_pieces", *(f"_hot_{k}" for k in on))


def split_hot_keys(
    big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Sequence[str],
    hot_rows: int = HOT_ROWS, heat: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with a ``_piece`` column, so that a hot key becomes several join keys.

    ``spread_by`` names columns that differ between the rows of a hot key. The small side repeats
    its row of a hot key once per piece.
    """
    keys = list(on)
    hot = hot_keys(big if heat is None else heat, keys, hot_rows)
    copies = F.explode(F.sequence(F.lit(0), _pieces() - 1))
    small_split = small.join(F.broadcast(hot), keys, "left").withColumn("_piece", copies).drop("_pieces")
    return mark_pieces(big, hot, keys, spread_by), small_split, [*keys, "_piece"]


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    size: int | None = None,
    heat: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join ``big`` with ``small`` ("inner", "left", "left_semi" or "left_anti").

    ``size`` replaces Catalyst's estimate where the caller knows better (it multiplies sizes at joins
    and does not see what an explode adds). ``heat`` is a cheaper table with at least the rows of
    ``big`` per key, to find hot keys without computing ``big`` twice.
    """
    keys = list(on)
    limit = broadcast_limit(small)
    if (estimated_bytes(small) if size is None else size) <= limit:
        return big.join(F.broadcast(small), keys, how)
    left, right, join_keys = split_hot_keys(big, small, keys, spread_by, hot_rows, heat)
    if _catalyst_bytes(right) <= limit:  # Catalyst would broadcast on an estimate known to be low
        right = right.hint("merge")
    return left.join(right, join_keys, how).drop("_piece")
