"""Data-quality gates: each is a job whose rows are the violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions import geometry as G
from freshet.functions import scalars as S

CLASSES = (S.OBSERVED, S.FORECAST, S.SIMULATED)
COLOURS = ("GREEN", "YELLOW", "RED")


def violations(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule; all rules are evaluated in a single pass."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]))
    return df.select(*keys, F.explode(broken).alias("violation"))


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def provenance_gate(values: DataFrame, keys: list[str], roles: dict[str, tuple[str, ...]]) -> DataFrame:
    """Values (role, cls, source, retrieved_at) without provenance or with a class their role forbids."""
    rules = {
        "missing source": blank(F.col("source")),
        "missing retrieved_at": blank(F.col("retrieved_at")),
        "bad class": F.col("cls").isNull() | ~F.col("cls").isin(*CLASSES),
    }
    for role, allowed in roles.items():
        rules[f"{role} must be {'/'.join(allowed)}"] = (F.col("role") == role) & F.col("cls").isin(*CLASSES) & ~F.col("cls").isin(*allowed)
    return violations(values, keys, rules)


def sidecar_gate(partitions: DataFrame, sidecars: DataFrame, keys: list[str], partial_year: int) -> DataFrame:
    """Partitions whose metadata row is missing or incomplete, or whose partial year is not flagged."""
    j = partitions.join(sidecars.withColumn("_has", F.lit(True)), keys, "left")
    has = F.coalesce("_has", F.lit(False))
    cls_ok = (F.col("cls") == S.OBSERVED) | ((F.col("cls") == S.FORECAST) & F.coalesce("archived", F.lit(False)))
    return violations(
        j,
        keys,
        {
            "sidecar missing": ~has,
            "sidecar incomplete": has & (~F.coalesce(cls_ok, F.lit(False)) | blank(F.col("source")) | blank(F.col("retrieved_at"))),
            "partial year not flagged": has & (F.col("year") == partial_year) & ~F.coalesce("partial", F.lit(False)),
        },
    )


def colour_gate(published: DataFrame, key: str) -> DataFrame:
    """Published colour (method, colour, score, p_elevated, p_extreme, basis) against its own inputs and text."""
    model, rule = F.startswith("method", F.lit("model")), F.col("method") == "heuristic"
    has_p = F.col("p_elevated").isNotNull() & F.col("p_extreme").isNotNull()
    text = F.lower("basis")
    high = F.contains(text, F.lit("unusually high")) | F.contains(text, F.lit("raised chance"))
    return violations(
        published,
        [key],
        {
            "model without probabilities": model & ~has_p,
            "colour differs from probabilities": model & has_p & (S.two_tier_colour(F.col("p_elevated"), F.col("p_extreme")) != F.col("colour")),
            "colour differs from score": rule & (S.risk_class(F.col("score")) != F.col("colour")),
            "unknown method": ~model & ~rule,
            "red with calm text": (F.col("colour") == "RED") & F.contains(text, F.lit("normal range")),
            "green with alarming text": (F.col("colour") == "GREEN") & high,
        },
    )


def marks_gate(stations: DataFrame, key: str) -> DataFrame:
    """Official marks, trend words, peaks, pin positions and stale flags of stations."""
    off = G.planar_km(F.col("gauge_lat"), F.col("gauge_lon"), F.col("pin_lat"), F.col("pin_lon"))
    words = ("rising", "falling", "steady")
    return violations(
        stations,
        [key],
        {
            "warning above danger": F.col("warning") > F.col("danger"),
            "bad trend word": F.col("trend").isNotNull() & ~F.col("trend").isin(*words),
            "peak above danger without time": F.col("warning").isNotNull() & (F.col("peak") >= F.col("danger")) & F.col("peak_at").isNull(),
            "pin away from gauge": off > 0.5,
            "stale without since": F.col("stale") & (blank(F.col("since")) | blank(F.col("checked_at"))),
        },
    )


def all_gates(*parts: tuple[str, DataFrame]) -> DataFrame:
    """Violations of several gates in one table."""
    named = [df.select(F.lit(n).alias("gate"), "violation") for n, df in parts]
    return reduce(lambda a, b: a.unionByName(b), named).groupBy("gate", "violation").agg(F.count(F.lit(1)).alias("n"))
