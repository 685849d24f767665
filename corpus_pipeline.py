"""From raw documents to packed training sequences, stage by stage.

``STAGES`` are applied in order, each to what the one before has kept; every stage's result is written
as Parquet and read back, so a lost executor repeats at most one stage.

Rows with NULL in any column go through; a NULL text is an empty one. Empty tables give empty ones. Columns other
than ``COLUMNS`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.llm import mixing, neardup, packing, quality_crf, substring
from tripgrain.llm.queries import remainder, vocabulary
from tripgrain.session import freeze

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are good by their length-weighted mean."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = quality_crf.train(docs, labels, remainder(4) != 2)
    scored = quality_crf.with_quality(docs.select(*COLUMNS), field, "_score")
    return scored.where(F.col("_score") >= quality_crf.CUTOFF).select(*COLUMNS)


def with_own_ids(docs: DataFrame) -> DataFrame:
    """``docs`` where a doc_id names one row: equal texts of one doc_id, or of none, are one row.

    Where a doc_id is NULL or has several texts, its rows get ids from a hash of doc_id and text. These are above
    2**62, so that a row with an id of its own, if below that, comes before them.
    """
    several = freeze(docs.groupBy("doc_id").agg(F.count("*").alias("_rows")).where("_rows > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_odd")))
    if several.isEmpty():  # the same rows by a shorter plan
        return docs
    named = docs.join(several, F.col("doc_id") == F.col("_odd"), "left_anti").where("doc_id IS NOT NULL")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    odd = docs.join(several, F.col("doc_id").eqNullSafe(F.col("_odd")), "left_semi")
    odd = freeze(odd.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("_rest")).select("doc_id", "text", "_rest.*"))
    own = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), "text").bitwiseAND((1 << 62) - 1).bitwiseOR(F.lit(1 << 62))
    single = odd.groupBy("doc_id").agg(F.count("*").alias("_texts")).where("_texts = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_single"))
    odd = odd.join(single, F.col("doc_id") == F.col("_single"), "left").withColumn("doc_id", F.coalesce("_single", own)).drop("_single")
    return named.unionByName(odd)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id, as :func:`with_own_ids` names rows."""
    docs = with_own_ids(docs.select(*COLUMNS))
    gone = neardup.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document with a smaller doc_id has."""
    cut = substring.remove_repeats(docs, carry=("lang", "source"))
    return cut.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies by source, in shuffled order."""
    return mixing.mix_sources(docs.select(*COLUMNS)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), markers=True)


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_duplicates),
    ("substring dedup", repeats),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

#: The classifier, the token ids and the packing have no SQL form; tests/llm/test_pipeline.py compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir))
    return docs
