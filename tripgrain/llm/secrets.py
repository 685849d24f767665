"""Secrets in texts, told apart from examples by who owns them over the whole corpus.

Patterns find candidates. The three base kinds always stay. The wider kinds (keys with a known prefix,
logins in addresses, opaque strings) would bring many examples that everybody copies; so every value is
hashed and counted by distinct repositories and owners, and a candidate of these kinds is added only if few
have it, as somebody's own credential would be.

All steps are DataFrame functions. Texts are read once and never shuffled: what moves are candidates, which
are few. A value with more than a thousandth of all candidates is looked up by broadcast, and of these there
are fewer than a thousand; the others meet their counts in a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.session import freeze

#: A value is somebody's own while it has at most so many owners and repositories.
MOST_OWNERS, MOST_REPOSITORIES = 2, 20
#: Values with more than this part of all candidates are broadcast.
HOT_PART = 1000
#: Running sums over the matches of a text are taken by blocks of so many.
BLOCK = 256


class Kind(NamedTuple):
    name: str
    pattern: str  # every match takes at least one character
    group: int  # the group that is the secret's value
    least: int  # characters of the value
    needs: tuple[str, ...] = ()  # patterns that the value must contain, each


#: The base kinds, in the order of their ranks.
BASE = (
    Kind(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2, 6,
    ),
    Kind("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: The kinds that ownership decides on.
WIDER = (
    Kind("key", r"(?:gh[oprsu]_|xox[abprs]-|glpat-|npm_|hf_|sk-|[rs]k_live_|AIza)[A-Za-z0-9_-]{16,}", 0, 20),
    Kind("login", r"://[^\x20\x09-\x0D/:@]+:([^\x20\x09-\x0D/:@]+)@", 1, 6),
    Kind("opaque", r"[A-Za-z0-9+_=-]{20,}", 0, 20, ("[0-9]", "[A-Z]", "[a-z]")),
)
KINDS = BASE + WIDER
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _before(sizes: Column) -> Column:
    """For each of ``sizes`` (one at least) the sum of those before it."""
    last = F.size(sizes) - 1
    totals = F.transform(F.sequence(F.lit(0), F.floor(last / BLOCK).cast("int")),
                         lambda b: _sum(F.slice(sizes, b * BLOCK + 1, BLOCK)))
    return _let(
        _let(totals, lambda t: F.transform(F.sequence(F.lit(0), F.size(t) - 1), lambda b: _sum(F.slice(t, F.lit(1), b)))),
        lambda blocks: F.transform(
            F.sequence(F.lit(0), last),
            lambda i: blocks[F.floor(i / BLOCK).cast("int")]
            + _sum(F.slice(sizes, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)),
        ),
    )


def _spans(text: Column, rank: int) -> Column:
    """Matches of a kind in places of code points, leftmost first, without those that fail its conditions."""
    kind = KINDS[rank]

    def places(found: Column, values: Column, between: Column) -> Column:
        sizes = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda a, b: F.char_length(a) + F.char_length(b))
        return _let(sizes, lambda s: _let(_before(s), lambda before: F.transform(found, lambda match, i: F.struct(
            (before[i] + s[i] - F.char_length(match)).alias("start"),
            F.lit(rank).alias("kind"),
            (before[i] + s[i]).alias("end"),
            values[i].alias("value"),
        ))))

    def good(span: Column) -> Column:
        out = F.char_length(span["value"]) >= kind.least
        for need in kind.needs:
            out = out & span["value"].rlike(need)
        return out

    found = _let(F.struct(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)).alias("values"),
        F.split(text, kind.pattern, -1).alias("between"),
    ), lambda x: F.filter(places(x["found"], x["values"], x["between"]), good))
    return F.when(text.rlike(kind.pattern), found).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def _written(spans: Column) -> Column:
    """``kind:start:end`` of spans by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")


def find(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """Each row's candidates, stored: _row, doc_id, _owner, _repository, _found (spans of all kinds with hashed values).

    A candidate of a wider kind goes where it overlaps one of an earlier kind.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id",
        F.col(owner).cast("string").alias("_owner"), F.col(repository).cast("string").alias("_repository"),
        *[_spans(text, rank).alias(f"_spans{rank}") for rank in range(len(KINDS))],
    )
    column = lambda rank: F.col(f"_spans{rank}")

    def free(rank: int) -> Column:
        apart = lambda s: ~F.exists(
            F.concat(*map(column, range(rank))), lambda e: (e["start"] < s["end"]) & (s["start"] < e["end"]))
        return F.when(F.size(column(rank)) > 0, F.filter(column(rank), apart)).otherwise(column(rank))

    kept = F.concat(*map(column, range(len(BASE))), *map(free, range(len(BASE), len(KINDS))))
    hashed = F.transform(kept, lambda s: F.struct(s["start"], s["kind"], s["end"], F.md5(s["value"]).alias("value")))
    return freeze(spans.select("_row", "doc_id", "_owner", "_repository", hashed.alias("_found")))


def ownership(found: DataFrame) -> DataFrame:
    """value, owners, repositories, candidates: how far each value of ``find`` has spread, stored.

    Repositories are told apart within their owner. NULL counts as one owner or repository of its own.
    """
    each = found.select("_owner", "_repository", F.explode("_found.value").alias("value"))
    return freeze(
        each.groupBy("value", "_owner", "_repository").agg(F.count("*").alias("n"))
        .groupBy("value", "_owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
        .groupBy("value").agg(
            F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("candidates"))
    )


def scan(
    docs: DataFrame, owner: str = "source", repository: str = "doc_id",
    most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """Spans of secrets in every whole text: doc_id, base, spans, own, copied, one row per input row.

    ``base`` and ``spans`` are arrays of (start, kind, end, value): places of whole matches in code points, end
    exclusive, the rank of the kind in ``KINDS``, and the MD5 of the value. ``spans`` holds ``base`` and those
    candidates of the wider kinds that are owner-specific: no more than ``most_owners`` owners and
    ``most_repositories`` repositories have their value anywhere in ``docs``, under any kind. ``own`` and
    ``copied`` count all candidates of the row by that verdict.

    NULL and empty texts have none. NULL owners are one owner, NULL repositories one repository of it. Repeated
    rows, and rows with equal or NULL doc_ids, are judged each on its own; copies of one row by one owner are one
    repository. Other columns of ``docs`` are ignored whatever their names. An empty table gives none.
    """
    found = find(docs, owner, repository)
    spread = ownership(found).withColumn(
        "_own", (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories))
    total = spread.agg(F.coalesce(F.sum("candidates"), F.lit(0))).first()[0]
    verdict = spread.select("value", "_own")
    hot = verdict.where(F.col("candidates") * HOT_PART > total) if total else verdict.limit(0)
    cold = spread.where(F.col("candidates") * HOT_PART <= total).select("value", "_own")
    each = found.select("_row", F.explode("_found").alias("_span")).withColumn("value", F.col("_span.value"))
    judged = each.join(F.broadcast(hot), "value").unionByName(
        each.join(F.broadcast(hot), "value", "left_anti").join(cold.hint("shuffle_merge"), "value"))
    wider = F.col("_span.kind") >= len(BASE)
    of_row = judged.groupBy("_row").agg(
        F.collect_list(F.when(wider & F.col("_own"), F.col("_span"))).alias("_added"),
        F.sum(F.col("_own").cast("long")).alias("own"),
        F.sum((~F.col("_own")).cast("long")).alias("copied"),
    )
    base = F.filter("_found", lambda s: s["kind"] < len(BASE))
    some = found.where(F.size("_found") > 0).join(of_row, "_row").select(
        "doc_id", base.alias("base"), F.concat(base, F.col("_added")).alias("spans"), "own", "copied")
    none = found.where(F.size("_found") == 0).select(
        "doc_id", F.col("_found").alias("base"), F.col("_found").alias("spans"),
        F.lit(0).cast("long").alias("own"), F.lit(0).cast("long").alias("copied"))
    return some.unionByName(none)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and texts of what ``scan`` found: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_own, n_copied."""
    count = lambda rank: F.size(F.filter("base", lambda s: s["kind"] == rank)).cast("long")
    return scanned.select(
        "doc_id",
        *[count(rank).alias(f"n_{kind.name}") for rank, kind in enumerate(BASE)],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
        F.col("own").alias("n_own"), F.col("copied").alias("n_copied"),
    )
