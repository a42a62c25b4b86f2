"""Attach scores to providers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.scores import score_band, score_key, utilization_band

INDIVIDUAL_SCORE_KEY = ["npi", "provider_type", "fips", "score_key"]
ORGANIZATION_SCORE_KEY = ["npi", "address_key", "state", "fips"]


def with_score_key(individuals: DataFrame) -> DataFrame:
    return individuals.withColumn(
        "score_key", score_key(F.col("provider_type"), F.col("specialty"))
    )


def left_join_one(rows: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """Left join with a table that holds at most one row per key.

    The key columns are compared as one struct. Such a table usually comes from a grouping
    by the same columns, and Spark would then join right above that grouping, where
    adaptive execution cannot split a key that holds a large share of the rows. For the
    struct both sides are exchanged, and it can.
    """
    values = [c for c in table.columns if c not in key]
    right = table.select(F.struct(*key).alias("joined_key"), *values)
    return rows.join(right, F.struct(*[rows[c] for c in key]) == right["joined_key"], "left").drop(
        "joined_key"
    )


def score_individuals(individuals: DataFrame, scores: DataFrame) -> DataFrame:
    """Left join on provider, type, county and score key; scores hold one row per key."""
    return left_join_one(with_score_key(individuals), scores, INDIVIDUAL_SCORE_KEY)


def score_organizations(organizations: DataFrame, scores: DataFrame) -> DataFrame:
    """Left join on provider, normalised address, state and county."""
    return left_join_one(organizations, scores, ORGANIZATION_SCORE_KEY)


def with_bands(scored: DataFrame) -> DataFrame:
    return scored.select(
        "*",
        score_band(F.col("quality")).alias("quality_band"),
        score_band(F.col("cost")).alias("cost_band"),
        utilization_band(F.col("ma_util")).alias("utilization_band"),
    )
