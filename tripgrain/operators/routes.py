"""Rule-based route classification and the route dimension."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrain.operators.joins import estimated_bytes, lookup_join
from tripgrain.operators.keys import add_key


class RouteRule(NamedTuple):
    route_type: int
    prefix: str
    mode: str
    text: str


# Rules, in order of precedence, and the label of everything else in the route types.
PHASE1_RULES = (
    RouteRule(106, "RE", "RE", "RouteType 106 + RE prefix"),
    RouteRule(106, "RB", "RB", "RouteType 106 + RB prefix"),
    RouteRule(109, "S", "S-Bahn", "RouteType 109 + S prefix"),
)
FALLBACK_MODE = "Other Rail"
FALLBACK_TEXT = "Excluded from Phase 1 after profiling"


def classify_routes(
    routes: DataFrame,
    rules: Sequence[RouteRule] = PHASE1_RULES,
    fallback: tuple[str, str] = (FALLBACK_MODE, FALLBACK_TEXT),
    case_insensitive: bool = False,
) -> DataFrame:
    """Mode, scope flag and the rule used, for every route of the rules' types.

    Routes that match no rule stay in the table under the fallback label.
    """
    name = F.upper("RouteShortName") if case_insensitive else F.col("RouteShortName")
    mode, text = F, F
    for rule in rules:
        prefix = rule.prefix.upper() if case_insensitive else rule.prefix
        matches = (F.col("RouteType") == rule.route_type) & name.startswith(prefix)
        mode, text = mode.when(matches, rule.mode), text.when(matches, rule.text)
    modes = [rule.mode for rule in rules]
    return (
        routes.filter(F.col("RouteType").isin(sorted({rule.route_type for rule in rules})))
        .withColumn("TransportMode", mode.otherwise(fallback[0]))
        .withColumn("ClassificationRule", text.otherwise(fallback[1]))
        .select(
            "RouteId",
            "RouteShortName",
            "RouteType",
            "TransportMode",
            F.col("TransportMode").isin(modes).alias("IsPhase1"),
            "ClassificationRule",
        )
    )


def in_scope(classification: DataFrame) -> DataFrame:
    return classification.filter("IsPhase1").select("RouteId", "TransportMode")


def classification_summary(classification: DataFrame) -> DataFrame:
    return (
        classification.groupBy("TransportMode", "IsPhase1")
        .agg(F.count("*").alias("RouteCount"))
        .orderBy(F.desc("IsPhase1"), "TransportMode")
    )


def build_dim_route(
    routes: DataFrame, classification: DataFrame, agency: DataFrame, with_key: bool = True
) -> DataFrame:
    """In-scope routes with their operator; a route whose agency is unknown stays, without a name."""
    scope = in_scope(classification)
    if with_key:
        scope = add_key(scope, ["RouteId"], "RouteKey")
    operators = agency.select("AgencyId", F.col("AgencyName").alias("OperatorName"))
    listed = lookup_join(routes, scope, ["RouteId"], ["RouteId"], size=estimated_bytes(routes))
    named = lookup_join(listed, operators, ["AgencyId"], ["RouteId"], "left", heat=routes)
    return named.select(
        *(["RouteKey"] if with_key else []),
        "RouteId",
        "RouteShortName",
        "RouteLongName",
        "TransportMode",
        "AgencyId",
        "OperatorName",
        F.col("RouteType").alias("SourceRouteType"),
    )
