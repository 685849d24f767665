"""Mixing sources to target weights by Poisson replication.

A source with a share of the rows and a target weight gets the mean repetition rate
``weight * size * rows / rows of the source``. Each row draws its number of copies from the Poisson
distribution with that mean, inverted at a uniform number made from a hash of its doc_id and the seed:
the same rows and seed always give the same copies, on any partitioning. Copies are then put in
the order of a hash of (doc_id, copy, seed), a global shuffle that does not depend on partitions either.

Only DataFrame functions. Rates are one small row per source; they are broadcast when counted below
``BROADCAST_SOURCES`` and otherwise joined by source with the rows of a source salted over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.session import freeze

#: Exponent of a source's share that gives its weight where no target weights are named.
TEMPERATURE = 0.7
SEED = "mix-1"
BROADCAST_SOURCES = 50_000
SALTS = 32
_STEP = 2.0**-52


def uniform(*parts: Column | str) -> Column:
    """A number in (0, 1) from a hash of the parts, the same in every engine that has md5."""
    texts = [F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit("null")) for p in parts]
    digits = F.substring(F.md5(F.concat_ws(":", *texts).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) * _STEP


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, size: float = 1.0,
          temperature: float = TEMPERATURE) -> DataFrame:
    """(source, n, rate, steps) per source; ``steps`` are cumulative Poisson probabilities of 0, 1, 2, ... copies.

    ``weights`` are target shares by source (unnamed sources: 0; they need not add up to 1). Without them
    a source gets the power ``temperature`` of its share. ``size`` is the wanted number of rows per input
    row. NULL is a source of its own.
    """
    n = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        wanted = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        named = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        wanted = F.coalesce(F.try_element_at(F.create_map(*named), F.col("source")), F.lit(0.0)) if named else F.lit(0.0)
    weighed = freeze(n.withColumn("weight", wanted))
    total = weighed.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights"))
    rate = F.when(F.col("weights") > 0, F.lit(size) * F.col("weight") * F.col("rows") / F.col("weights") / F.col("n")).otherwise(0.0)
    most = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    # each probability from the one before: p(k) = p(k - 1) * rate / k, in log space so that no rate underflows
    start = F.struct((-F.col("rate")).alias("log"), F.exp(-F.col("rate")).alias("sum"),
                     F.array(F.exp(-F.col("rate"))).alias("steps"))

    def step(have: Column, k: Column) -> Column:
        log = have["log"] + F.log("rate") - F.log(k)
        return F.struct(log.alias("log"), (have["sum"] + F.exp(log)).alias("sum"),
                        F.concat(have["steps"], F.array(have["sum"] + F.exp(log))).alias("steps"))

    steps = F.when(F.col("rate") <= 0, F.array(F.lit(1.0))).otherwise(
        F.aggregate(F.sequence(F.lit(1), most).cast("array<double>"), start, step)["steps"])
    return weighed.crossJoin(total).withColumn("rate", rate).select("source", "n", "rate", steps.alias("steps"))


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, size: float = 1.0, seed: str = SEED,
                temperature: float = TEMPERATURE, broadcast_sources: int = BROADCAST_SOURCES) -> DataFrame:
    """Copies of the rows of ``docs`` (doc_id, source, ...), all columns, and copy (from 0), place.

    Rows come in the order of ``place``, a number in (0, 1). A row with rate r has r copies on average and
    none with probability exp(-r). Rows that share a doc_id draw the same number. NULL ids draw one
    number together. Columns called copy or place are replaced; an empty table gives none.
    """
    docs = docs.drop("copy", "place")
    table = freeze(rates(docs, weights, size, temperature).select(F.col("source").alias("_llm_source"), F.col("steps").alias("_llm_steps")))
    if table.count() <= broadcast_sources:
        rated = docs.join(F.broadcast(table), docs["source"].eqNullSafe(table["_llm_source"]))
    else:
        salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
        table = table.withColumn("_llm_salt", salt)
        salted = docs.withColumn("_llm_pick", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        rated = salted.join(table.hint("shuffle_hash"), salted["source"].eqNullSafe(table["_llm_source"])
                            & (F.col("_llm_pick") == F.col("_llm_salt")))
    draw = uniform("doc_id", F.lit(seed))
    copies = F.size(F.filter("_llm_steps", lambda step: step <= draw))
    out = rated.withColumn("_llm_n", copies).where("_llm_n > 0").select(
        *docs.columns, F.explode(F.sequence(F.lit(0), F.col("_llm_n") - 1)).alias("copy"))
    return out.withColumn("place", uniform("doc_id", "copy", F.lit(seed + "-order"))).orderBy("place", "doc_id", "copy")
