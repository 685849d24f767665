"""Feed files: CSV with a header row, UTF-8, double quotes, columns by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.schemas import FEED
from tripgrain.session import freeze

REJECTED = "_rejected_line"


def _reader(spark: SparkSession, schema: str, strict: bool, multi_line: bool):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
    )


def read_feed(
    spark: SparkSession, folder: str, table: str, strict: bool = False, multi_line: bool = False
) -> DataFrame:
    """One feed table. Empty fields are NULL.

    The default keeps malformed lines with NULLs in place of what cannot be read (see
    :func:`rejected_lines`); ``strict`` fails the job instead. Files stay splittable unless
    ``multi_line`` is needed for line breaks inside quotes.
    """
    return _reader(spark, FEED[table], strict, multi_line).csv(f"{folder}/{table}.txt")


def rejected_lines(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Lines of a feed file that do not fit the declared schema."""
    schema = f"{FEED[table]}, {REJECTED} string"
    rows = (
        _reader(spark, schema, strict=False, multi_line=False)
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(f"{folder}/{table}.txt")
    )
    return rows.filter(F.col(REJECTED).isNotNull())


def split_lines(spark: SparkSession, folder: str, table: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """A feed file parsed once, as (rows, rejects): lines that fit the schema, and the text of those that do not.

    The parsed file is stored, so both parts come from the same reading and together have all its lines.
    """
    parsed = freeze(
        _reader(spark, f"{FEED[table]}, {REJECTED} string", False, multi_line)
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(f"{folder}/{table}.txt")
    )
    rejects = parsed.filter(F.col(REJECTED).isNotNull()).select(
        F.lit(table).alias("TableName"), F.col(REJECTED).alias("Line"))
    return parsed.filter(F.col(REJECTED).isNull()).drop(REJECTED), rejects


def with_load_stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("LoadDateTime", F.localtimestamp())
