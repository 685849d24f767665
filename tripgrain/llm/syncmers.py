"""Document fingerprints from closed syncmers, with DataFrame functions only.

A gram is ``GRAM`` words in a row; its inner substrings are the runs of ``INNER`` words in it. A gram is a
closed syncmer when its smallest inner hash is that of the first or the last inner run. Whether it is one
depends on its own words only, so equal passages have the same anchors wherever they stand, and between
two anchors there is always a known distance. Texts shorter than a gram are one anchor.

The fingerprint of a document is the sorted list of all its distinct anchor hashes as hexadecimal text.
Two texts are matched by place: the n-th anchor of a hash in one belongs to the n-th of it in the other, and
votes for the difference of their places. The likeness is the share, among the distinct hashes of both, of those that
vote for the difference with most hashes. Passages in another order, or after an insertion, stand at another difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.words import SPACE
from tripgrain.session import freeze

GRAM, INNER = 5, 2
#: Hashes that a fingerprint keeps at most: all.
KEEP = None
#: Bytes of text in a bucket of neighbouring doc_ids.
BUCKET_BYTES = 8 << 20


def _word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")
    return F.transform(words, lambda word: F.xxhash64(word))


def _anchors(hashes: str, inner: str) -> Column:
    """(place, hash) of the syncmers of a column of word hashes; ``inner`` holds hashes of their inner runs."""
    n, runs = F.size(hashes), GRAM - INNER + 1
    every = F.sequence(F.lit(1), n - (GRAM - 1))

    def closed(at: Column) -> Column:
        first, last = F.get(inner, at - 1), F.get(inner, at + (runs - 2))
        middle = [F.get(inner, at + (k - 1)) for k in range(1, runs - 1)]
        return F.least(first, last) <= F.least(*middle)

    grams = F.transform(F.filter(every, closed), lambda at: F.struct(
        (at - 1).alias("place"), F.xxhash64(F.slice(hashes, at, GRAM)).alias("hash")))
    whole = F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(F.col(hashes)).alias("hash")))
    return F.when(n >= GRAM, grams).when(n > 0, whole).otherwise(F.array().cast("array<struct<place:int,hash:bigint>>"))


def with_anchors(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` and the anchors of a text column as ``name``."""
    hashed, inner = f"_llm_{name}_words", f"_llm_{name}_inner"
    n = F.size(hashed)
    pairs = F.when(n >= GRAM, F.zip_with(F.slice(hashed, 1, n - 1), F.slice(hashed, 2, n - 1), lambda a, b: F.xxhash64(a, b)))
    return (docs.withColumn(hashed, _word_hashes(F.col(text))).withColumn(inner, pairs)
            .withColumn(name, _anchors(hashed, inner)).drop(hashed, inner))


def with_places(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the anchors ``name`` as (hash, nth, place) in this order, and ``<name>_hashes``, the distinct hashes in order."""
    ordered, starts, hashes = f"_llm_{name}_ordered", f"_llm_{name}_starts", f"{name}_hashes"
    n = F.size(ordered)
    begins = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(ordered, i)["hash"] != F.get(ordered, i - 1)["hash"]))

    def numbered(x: Column, nth: Column) -> Column:
        return F.struct(x["hash"].alias("hash"), nth.alias("nth"), x["place"].alias("place"))

    def run(start: Column, k: Column) -> Column:
        size = F.coalesce(F.get(starts, k + 1), n) - start
        return F.transform(F.slice(ordered, start + 1, size), numbered)

    single = F.transform(ordered, lambda x: numbered(x, F.lit(0)))
    return (docs.withColumn(ordered, F.sort_array(F.transform(name, lambda x: F.struct(x["hash"].alias("hash"), x["place"].alias("place")))))
            .withColumn(starts, F.when(n > 0, begins).otherwise(F.array().cast("array<int>")))
            .withColumn(hashes, F.transform(starts, lambda i: F.get(ordered, i)["hash"]))
            # most texts repeat nothing
            .withColumn(name, F.when(F.size(starts) == n, single).otherwise(F.flatten(F.transform(starts, run))))
            .drop(ordered, starts))


def fingerprint(hashes: Column) -> Column:
    """Sixteen hexadecimal digits per hash, joined."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_likeness(docs: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``docs`` and the likeness ``name`` of two columns of places; two empty ones are alike, an empty and another are not."""
    common, merged, votes = (f"_llm_{name}_{x}" for x in ("common", "merged", "votes"))

    def side(places: str, sign: int) -> Column:
        return F.transform(places, lambda x: F.struct(x["hash"].alias("hash"), x["nth"].alias("nth"), F.lit(sign).alias("sign"), x["place"].alias("place")))

    def paired(x: Column, i: Column) -> Column:
        after = F.get(merged, i + 1)
        return F.coalesce((after["hash"] == x["hash"]) & (after["nth"] == x["nth"]), F.lit(False))

    # of a pair the first row is that of ``a``
    firsts = F.filter(F.transform(merged, lambda x, i: F.when(paired(x, i), F.struct(
        (F.get(merged, i + 1)["place"] - x["place"]).alias("by"), x["hash"].alias("hash")))), lambda x: x.isNotNull())
    start = F.struct(F.lit(None).cast("int").alias("by"), F.lit(None).cast("bigint").alias("hash"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def count(have: Column, x: Column) -> Column:
        same = have["by"].eqNullSafe(x["by"])
        run = F.when(~same, 1).when(have["hash"] == x["hash"], have["run"]).otherwise(have["run"] + 1)
        return F.struct(x["by"].alias("by"), x["hash"].alias("hash"), run.alias("run"), F.greatest(have["best"], run).alias("best"))

    sizes = [F.size(f"{x}_hashes") for x in (a, b)]
    out = docs.withColumn(common, F.size(F.array_intersect(f"{a}_hashes", f"{b}_hashes")))
    out = out.withColumn(merged, F.when(F.col(common) > 0, F.sort_array(F.concat(side(a, 0), side(b, 1)))))
    out = out.withColumn(votes, F.when(F.col(common) > 0, F.sort_array(firsts)))
    best = F.coalesce(F.aggregate(votes, start, count)["best"], F.lit(0))
    return out.withColumn(name, F.when((sizes[0] == 0) & (sizes[1] == 0), 1.0).when(
        (sizes[0] == 0) | (sizes[1] == 0), 0.0).otherwise(best / (sizes[0] + sizes[1] - F.col(common)))).drop(common, merged, votes)


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    wide = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    # Literals, not columns: a bound per bucket of some MB
    coarse = F.expr("array(" + ",".join(f"{p[0]}L" for p in parts[1:]) + ")") if len(parts) > 1 else F.array().cast("array<bigint>")
    fine = F.expr("array(" + ",".join("array(" + ",".join(f"{x}L" for x in p) + ")" for p in parts) + ")")
    part = F.size(F.filter(coarse, lambda x: x <= key))
    return part * wide + F.size(F.filter(F.get(fine, part), lambda x: x <= key))


def with_next(docs: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """``docs`` and, as ``next_<column>``, columns of the row with the next smaller doc_id; after the last comes the first.

    Buckets are ranges of doc_id; the first row of each also stands, as a guest, at the end of the bucket
    before. Rows that share a doc_id follow each other in the order of ``columns``; NULL ids come last.
    """
    shares = [i / buckets for i in range(1, buckets)]
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    found = docs.agg(F.percentile_approx(key, shares, 10 * max(1000, buckets)).alias("bounds")).first().bounds if shares else []
    bounds = sorted(x for x in set(found or []) if x > -(2**63))
    placed = docs.withColumn("_llm_key", key).withColumn("_llm_bucket", _bucket(F.col("_llm_key"), bounds))
    # one row per bucket: its largest key, and the bucket that it follows
    heads = freeze(placed.groupBy("_llm_bucket").agg(F.max("_llm_key").alias("head")))
    order = [r for r in heads.orderBy(F.desc("_llm_bucket")).collect()]
    after = {order[i].head: order[i - 1]._llm_bucket for i in range(len(order))}  # the first follows the last
    if not after:
        host = F.lit(None).cast("int")
    else:
        host = F.try_element_at(F.map_from_arrays(
            F.expr("array(" + ",".join(f"{k}L" if k > -(2**63) else "(-9223372036854775807L - 1L)" for k in after) + ")"),
            F.expr("array(" + ",".join(map(str, after.values())) + ")")), F.col("_llm_key"))
    stays = F.array(F.struct(F.col("_llm_bucket").alias("at"), F.lit(False).alias("guest")),
                    F.struct(host.alias("at"), F.lit(True).alias("guest")))
    rows = placed.withColumn("_llm_stay", F.explode(stays)).where("_llm_stay.at IS NOT NULL")
    ties = ", ".join(f"`{c}`" for c in columns)
    # a guest stands behind the bucket's own rows; of equal keys the one that is first there is first here
    over = f"OVER (PARTITION BY _llm_stay.at ORDER BY _llm_stay.guest, _llm_key DESC, {ties})"
    nexts = [F.expr(f"lead(`{c}`) {over}").alias(f"next_{c}") for c in columns]
    return rows.select(*docs.columns, F.col("_llm_stay.guest").alias("_llm_guest"), *nexts).where("NOT _llm_guest").drop("_llm_guest")


def edited_neighbours(docs: DataFrame, total: int, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they and the next document's are.

    ``docs`` has doc_id and text; NULL text is empty. The edited text has its last third (floor of code
    points / 3) replaced by as many first code points, or all, of the next document in descending doc_id. A
    single document follows itself. Other columns are ignored; an empty table gives none.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows, ["text"], max(1, -(-total // bucket_bytes)))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    for text, name in (("text", "own"), ("edited", "changed"), ("next_text", "next")):
        rows = with_places(with_anchors(rows, text, name), name).drop(*[text] * (text != "edited"))
    rows = with_likeness(with_likeness(rows, "own", "changed", "near_edited"), "own", "next", "near_next")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("own_hashes")).alias("fingerprint"),
        fingerprint(F.col("changed_hashes")).alias("edited_fingerprint"), "near_edited", "near_next")
