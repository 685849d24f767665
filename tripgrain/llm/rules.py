"""Quality rules whose thresholds keep a bound on rejected good documents, with DataFrame functions only.

Four measures of each text are held against a cutoff per stratum (language). Labelled documents are the
holdout: of the good ones of a stratum, ``n`` in number, the cutoff may reject at most ``r``, where ``r`` is the
largest number with P(Binomial(n, RISK / rules) <= r) <= LEVEL / (rules * strata). By the exact binomial bound the
true share of good documents that a rule rejects is then below RISK / rules, for all rules and strata at
once with probability 1 - LEVEL (Bonferroni), and a document is rejected wrongly with at most RISK.
The smallest cutoff allowed so is raised to the smallest value of a bad document above it, which
rejects the same bad ones and fewer good ones. A stratum with too few labels rejects nothing by these rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.words import SPACE
from tripgrain.operators.keys import running_total
from tripgrain.session import freeze

REPEAT = 8
RISK, LEVEL = 0.02, 0.05
SYMBOLS = "[#*$%&|<>]"
#: Measures that are rejected when large.
RULES = ("symbol_share", "dup_line_share", "repeat_share", "shout_share")


def _repeated_words(hashes: str) -> tuple[Column, Column, Column, Column]:
    """Steps towards the number of words inside runs of ``REPEAT`` words that are found twice or more.

    Run hashes, runs in the order of their hashes, places of repeated runs, words that these cover.
    """
    runs = F.transform(F.sequence(F.lit(1), F.size(hashes) - (REPEAT - 1)), lambda i: F.xxhash64(F.slice(hashes, i, REPEAT)))
    sorted_runs = F.sort_array(F.transform(F.col("_llm_runs"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def same(one: Column, two: Column) -> Column:
        return F.coalesce(one["h"] == two["h"], F.lit(False))

    twice = F.filter(F.col("_llm_order"), lambda x, k: same(F.get("_llm_order", k - 1), x) | same(F.get("_llm_order", k + 1), x))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        F.transform(F.col("_llm_places"), lambda p, k: F.least(F.lit(REPEAT), F.coalesce(F.get("_llm_places", k + 1) - p, F.lit(REPEAT)))),
        F.lit(0), lambda a, b: a + b)
    return runs, sorted_runs, places, covered


def with_measures(docs: DataFrame) -> DataFrame:
    """``docs`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed and the measures of ``RULES``.

    NULL text has no words. Equal runs of words are found by 64-bit hashes within one text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    out = docs.withColumn("_llm_words", words).withColumn("_llm_hashes", F.transform("_llm_words", lambda word: F.xxhash64(word)))
    n = F.size("_llm_words")
    runs, order, places, covered = _repeated_words("_llm_hashes")
    none = F.array().cast("array<bigint>")
    out = out.withColumn("_llm_runs", F.when(n > REPEAT, runs).otherwise(none))
    # most texts repeat nothing: only the others are sorted
    repeats = F.size(F.array_distinct("_llm_runs")) < F.size("_llm_runs")
    out = out.withColumn("_llm_order", F.when(repeats, order))
    out = out.withColumn("_llm_places", F.when(F.col("_llm_order").isNotNull(), places))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\x0b\x0c\r"))) > 0)
    out = out.withColumn("_llm_lines", F.transform(lines, lambda line: F.xxhash64(line)))
    joined = F.array_join("_llm_words", "")
    dup = F.size("_llm_lines") - F.size(F.array_distinct("_llm_lines"))
    out = out.select(
        *docs.columns, n.cast("long").alias("n_words"), F.char_length(joined).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), dup.cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("_llm_places").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_llm_lines").alias("_llm_n_lines"),
        F.regexp_count(text, F.lit(r"!|\?")).alias("_llm_shouts"))
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))
    return (out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
            .withColumn("symbol_share", share("n_symbols", "word_chars"))
            .withColumn("dup_line_share", share("n_dup_lines", "_llm_n_lines"))
            .withColumn("repeat_share", share("n_repeat_words", "n_words"))
            .withColumn("shout_share", share("_llm_shouts", "n_words"))
            .drop("_llm_n_lines", "_llm_shouts"))


def _log_gamma(x: Column) -> Column:
    """Stirling's series after shifting by eight; exact to about 1e-13 for x >= 1."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    shift = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - shift


def allowed_rejections(n: Column, risk: Column, level: Column) -> Column:
    """Largest r with P(Binomial(n, risk) <= r) <= level, or -1.

    Terms below twelve standard deviations under the mean, together under 1e-30, are left out of the sum.
    """
    first = F.greatest(F.lit(0), F.floor(n * risk - 12 * F.sqrt(n * risk) - 30)).cast("long")
    last = F.greatest(first, F.ceil(n * risk).cast("long"))
    log = (_log_gamma(n + 1.0) - _log_gamma(first + 1.0) - _log_gamma(n - first + 1.0)
           + first * F.log(risk) + (n - first) * F.log(1 - risk))
    start = F.struct(log.alias("log"), F.lit(0.0).alias("sum"), (first - 1).alias("r"))

    def step(have: Column, k: Column) -> Column:
        total = have["sum"] + F.exp(have["log"])
        after = have["log"] + F.log((n - k) / (k + 1.0)) + F.log(risk) - F.log(1 - risk)
        return F.struct(F.coalesce(after, F.lit(-1e300)).alias("log"), total.alias("sum"), F.when(total <= level, k).otherwise(have["r"]).alias("r"))

    found = F.aggregate(F.sequence(first, F.least(last, n)), start, step)["r"]
    return F.when((n <= 0) | (found < first), F.lit(-1)).otherwise(found).cast("long")


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(stratum, rule, n, allowed, cutoff): a document is rejected when its measure is at least ``cutoff``; NULL rejects none.

    Only documents that pass the base rules count, since only they are judged. Values are counted per distinct value
    before anything is ordered, so ties are one row.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_llm_good"))
    held = measured.where(~F.col("base_failed")).join(known, "doc_id").select(
        F.col(stratum).alias("stratum"), "_llm_good",
        F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES))).alias("m"))
    values = freeze(held.groupBy("stratum", "m.rule", "m.value").agg(
        F.count_if(F.col("_llm_good") == 1).alias("good"), F.count_if(F.col("_llm_good") == 0).alias("bad")))
    totals = values.groupBy("stratum", "rule").agg(F.sum("good").alias("n"))
    strata = totals.agg(F.count_distinct(F.coalesce(F.col("stratum").cast("string"), F.lit("\0null"))).alias("strata"))
    bound = totals.crossJoin(strata).withColumn("allowed", allowed_rejections(
        F.col("n"), F.lit(risk / len(RULES)), F.lit(level) / (len(RULES) * F.greatest(F.col("strata"), F.lit(1)))))
    bound = freeze(bound.drop("strata").withColumnsRenamed({"stratum": "_s", "rule": "_r"}))
    # good documents at or above each value: one running sum over range partitions, less what stands before its stratum and rule
    summed = running_total(values.withColumn("_llm_down", -F.col("value")), ["stratum", "rule", "_llm_down"], "good", "_llm_before", one_task_bytes=0)
    base = summed.groupBy(F.col("stratum").alias("_bs"), F.col("rule").alias("_br")).agg(F.min("_llm_before").alias("_llm_base"))
    bound_base = bound.join(base, bound["_s"].eqNullSafe(F.col("_bs")) & (bound["_r"] == F.col("_br"))).select("_s", "_r", "allowed", "_llm_base")
    same = summed["stratum"].eqNullSafe(F.col("_s")) & (summed["rule"] == F.col("_r"))
    above = summed.join(bound_base, same).withColumn("reach", F.col("_llm_before") - F.col("_llm_base") + F.col("good"))
    fine = above.where("bad > 0 AND reach <= allowed").groupBy("stratum", "rule").agg(F.min("value").alias("cutoff"))
    fine = fine.withColumnsRenamed({"stratum": "_fs", "rule": "_fr"})
    return bound.join(fine, bound["_s"].eqNullSafe(fine["_fs"]) & (bound["_r"] == fine["_fr"]), "left").select(
        F.col("_s").alias("stratum"), F.col("_r").alias("rule"), "n", "allowed", "cutoff")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, level: float = LEVEL,
          broadcast_strata: int = 50_000) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept per row of ``docs``.

    NULL is a stratum of its own. Without labels only the base rules reject. Rows that share a doc_id are
    judged each; other columns are ignored. An empty table gives none.
    """
    measured = freeze(with_measures(docs.select("doc_id", "text", F.col(stratum).alias("lang"))).drop("text"))
    found = cutoffs(measured, labels, "lang", risk, level)
    wide = freeze(found.groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in RULES)))
    if wide.count() <= broadcast_strata:
        wide = F.broadcast(wide)
    failed = F.lit(False)
    for r in RULES:
        failed = failed | F.coalesce(F.col(r) >= F.col(f"_cut_{r}"), F.lit(False))
    return measured.join(wide, measured["lang"].eqNullSafe(F.col("stratum")), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~failed).alias("kept"))
