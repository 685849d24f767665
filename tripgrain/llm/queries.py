"""The registered queries of this subpackage and their DuckDB texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrain.llm import (
    alignment, automaton, mixing, neardup, packing, phrases, quality_crf, rules, secrets, substring, syncmers, token_files, toxicity,
)

from tripgrain.llm.words import text_bytes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(divisor: int):
    """crc32 of doc_id as text, modulo ``divisor``; a NULL doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "n_removed", F.sha2(substring.normal_words("text"), 256).alias("kept_sha256")
    )


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality_crf.train(docs, _table(spark, sf_dir, "labels"), remainder(4) != 2)
    return quality_crf.with_quality(docs, field).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "score",
        (F.col("score") >= quality_crf.CUTOFF).cast("int").alias("predicted"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), markers=True)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), remainder(5) != 0)
    return toxicity.with_toxicity(docs, model).select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), markers=True)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op7_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return syncmers.edited_neighbours(docs, text_bytes(docs))


def op8_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = automaton.score_texts(_table(spark, sf_dir, "documents"), remainder(5) != 1)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_pointer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(
        _table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op12_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_crf": op2_quality_crf,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_toxicity": op4_toxicity,
    "op5_token_files": op5_token_files,
    "op6_mix_sources": op6_mix_sources,
    "op7_syncmer_fingerprints": op7_syncmer_fingerprints,
    "op8_backoff_automaton": op8_backoff_automaton,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_risk_controlled_rules": op10_risk_controlled_rules,
    "op11_pointer_alignment": op11_pointer_alignment,
    "op12_secret_ownership": op12_secret_ownership,
    "op13_phrase_collocations": op13_phrase_collocations,
}

_OP1 = r"""
WITH w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), g AS (
    SELECT doc_id, i, sha256(array_to_string(words[i : i + 12], ' ')) AS h
    FROM w, unnest(range(1, greatest(len(words) - 11, 1))) AS t(i)
), m AS (
    SELECT h, min(doc_id) AS least FROM g GROUP BY h
), r AS (
    SELECT DISTINCT doc_id, p FROM g JOIN m USING (h), unnest(range(i, i + 13)) AS t(p) WHERE doc_id > least
), k AS (
    SELECT w.doc_id, p, words[p] AS word, r.p IS NULL AS kept
    FROM (SELECT *, unnest(range(1, len(words) + 1)) AS p FROM w) w LEFT JOIN r USING (doc_id, p)
), s AS (
    SELECT doc_id, count(*) FILTER (NOT kept) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (kept) AS t
    FROM k GROUP BY doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN s USING (doc_id)
"""

_OP6 = """
WITH n AS (
    SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY source
), r AS (
    SELECT source, pow(n::DOUBLE, 0.7) * sum(n) OVER () / sum(pow(n::DOUBLE, 0.7)) OVER () / n AS rate FROM n
), c AS (
    SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1.0))) OVER (PARTITION BY source ORDER BY k) AS below
    FROM r, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 31)::BIGINT)) AS t(k)
), u AS (
    SELECT *, (('0x' || md5(doc_id || ':mix-1')[1:13])::BIGINT + 0.5) / pow(2.0, 52) AS draw FROM documents
), x AS (
    SELECT u.*, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.below <= u.draw) AS copies FROM u
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
       (('0x' || md5(doc_id || ':' || copy || ':mix-1-order')[1:13])::BIGINT + 0.5) / pow(2.0, 52) AS place
FROM x, unnest(range(0, copies)) AS t(copy)
"""

_OP9 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, md5(array_to_string(words[i : i + 4], ' ')) AS h
    FROM w, unnest(range(1, greatest(len(words) - 3, 2))) AS t(i) WHERE len(words) > 0
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS MATERIALIZED (
    SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), r(doc_id, other) AS (
    SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other
), c AS (
    SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

def _op12_sql() -> str:
    """Candidates of each kind with their places, ownership of their values, and the digests of each row."""
    quoted = lambda pattern: "'" + pattern.replace("'", "''") + "'"
    kinds = []
    for rank, kind in enumerate(secrets.KINDS):
        pattern = quoted(kind.pattern)
        needs = "".join(f" AND regexp_matches(value, {quoted(need)})" for need in kind.needs)
        kinds.append(f"""
    SELECT * FROM (
        SELECT row, {rank} AS kind, '{kind.name}' AS name, value,
               sum(length(piece) + length(match)) OVER (PARTITION BY row ORDER BY i) AS last, length(match) AS size
        FROM (SELECT row, unnest(string_split_regex(text, {pattern})) AS piece,
                     unnest(regexp_extract_all(text, {pattern}, 0)) AS match,
                     unnest(regexp_extract_all(text, {pattern}, {kind.group})) AS value,
                     unnest(range(1, len(regexp_extract_all(text, {pattern}, 0)) + 1)) AS i
              FROM d WHERE regexp_matches(text, {pattern}))
        WHERE match IS NOT NULL
    ) WHERE length(value) >= {kind.least}{needs}""")
    return f"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents
), a AS ({" UNION ALL ".join(kinds)}
), s AS MATERIALIZED (
    SELECT row, kind, name, value, (last - size)::BIGINT AS start, last::BIGINT AS stop FROM a
), k AS MATERIALIZED (
    SELECT * FROM s WHERE kind < {len(secrets.BASE)}
    UNION ALL
    SELECT * FROM s WHERE kind >= {len(secrets.BASE)} AND NOT EXISTS (
        SELECT 1 FROM s e WHERE e.row = s.row AND e.kind < s.kind AND e.start < s.stop AND s.start < e.stop)
), o AS (
    SELECT value, count(DISTINCT coalesce('=' || source, '')) <= {secrets.MOST_OWNERS}
           AND count(DISTINCT [coalesce('=' || source, ''), coalesce('=' || doc_id, '')]) <= {secrets.MOST_REPOSITORIES} AS own
    FROM k JOIN d USING (row) GROUP BY value
), j AS (
    SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
           string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < {len(secrets.BASE)}) AS base,
           string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind)
               FILTER (kind < {len(secrets.BASE)} OR own) AS spans,
           count(*) FILTER (own) AS n_own, count(*) FILTER (NOT own) AS n_copied
    FROM k JOIN o USING (value) GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_own, 0)::BIGINT AS n_own, coalesce(n_copied, 0)::BIGINT AS n_copied
FROM d LEFT JOIN j USING (row)
"""


_OP13 = r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p
), f AS MATERIALIZED (
    SELECT lang, w[i : i + k - 1] AS g, count(*)::BIGINT AS f
    FROM w, unnest(range(1, 6)) AS t(k), unnest(range(1, len(w) - k + 2)) AS u(i) GROUP BY ALL HAVING f >= 100
), n AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), c AS (
    SELECT c.lang, c.g, c.f AS a, n, k, l.f AS l, r.f AS r,
           ((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1) c
    JOIN f l ON l.lang = c.lang AND l.g = c.g[1 : k] JOIN f r ON r.lang = c.lang AND r.g = c.g[k + 1 :] JOIN n ON n.lang = c.lang
), b AS (
    SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), inside AS (
    SELECT lang, g[i : j] AS g, max(f) AS f
    FROM f, unnest(range(1, len(g) + 1)) AS t(i), unnest(range(i + 1, len(g) + 1)) AS u(j)
    WHERE j - i + 1 < len(g) GROUP BY ALL
), o AS (
    SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM b LEFT JOIN inside x ON x.lang = b.lang AND x.g = b.g
    WHERE x.f IS NULL OR 100 * x.f < 100 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM o QUALIFY rank <= 2000
"""

ORACLE = {
    "op12_secret_ownership": _op12_sql(),
    "op13_phrase_collocations": _OP13,
    "op6_mix_sources": _OP6,
    "op9_near_duplicates": _OP9,
    "op1_substring_dedup": _OP1,
}
