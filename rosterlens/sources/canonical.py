"""Row rules shared by every source of providers and scores.

A source maps its own columns to the canonical names; these functions then apply the
filters, keys and types, so that files and driver tables follow one implementation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.scores import number, score_key, whole_number
from rosterlens.functions.text import match_key

# Accepted location confidences and provider types of individuals.
LOCATION_CONFIDENCES = ["Low", "Medium", "High", "LOCATION CONFIDENCE NOT AVAILABLE"]
INDIVIDUAL_TYPES = ["PCP", "Physician Specialists", "Other Providers"]
HOSPITAL = "Hospital"

INDIVIDUAL_KEY = ["npi", "state", "fips", "provider_type"]
ORGANIZATION_KEY = ["npi", "state", "fips", "address_key", "provider_type", "specialty_code"]


def has_key(columns: list[str]) -> Column:
    """True for rows whose key columns are all present."""
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present


def individual_is_reportable() -> Column:
    """An accepted location confidence and provider type."""
    return F.col("location_confidence").isin(LOCATION_CONFIDENCES) & F.col("provider_type").isin(
        INDIVIDUAL_TYPES
    )


def organization_is_reportable() -> Column:
    """Active, with a real provider type; a missing type does not count as real."""
    return (F.upper("status") == "ACTIVE") & (F.col("provider_type") != "None")


def with_address_key(organizations: DataFrame) -> DataFrame:
    return organizations.withColumn("address_key", match_key(F.col("address")))


def clean_individuals(rows: DataFrame) -> DataFrame:
    return rows.where(individual_is_reportable() & has_key(INDIVIDUAL_KEY))


def clean_organizations(rows: DataFrame) -> DataFrame:
    return with_address_key(rows).where(organization_is_reportable() & has_key(ORGANIZATION_KEY))


def exclude_codes(rows: DataFrame, code: str, codes: DataFrame) -> DataFrame:
    """Rows whose code is not listed in the one-column table ``codes``."""
    listed = codes.select(F.col(codes.columns[0]).alias(code))
    return rows.join(listed, code, "left_anti")


def _best(rows: DataFrame, key: list[str], ranking: list[str]) -> DataFrame:
    """One row per key: the largest by the ranking columns, missing values last.

    A maximum over a struct combines on the map side, so a key with very many score
    rows costs one row per input split in the shuffle.
    """
    best = F.max(F.struct(*ranking)).alias("best")
    return rows.where(has_key(key)).groupBy(*key).agg(best).select(*key, "best.*")


def individual_scores(rows: DataFrame) -> DataFrame:
    """Score texts to one row of numbers per provider, type, county and score key."""
    scores = rows.select(
        "npi",
        "provider_type",
        "fips",
        score_key(F.col("provider_type"), F.col("specialty")).alias("score_key"),
        *[
            number(F.col(name)).alias(name)
            for name in ("quality", "cost", "ma_util", "ffs_util", "npi_score")
        ],
        "colour",
    )
    return _best(
        scores,
        ["npi", "provider_type", "fips", "score_key"],
        ["quality", "cost", "ma_util", "ffs_util", "npi_score", "colour"],
    )


def organization_scores(rows: DataFrame) -> DataFrame:
    """Score texts to one row of numbers per provider, address, state and county."""
    scores = rows.select(
        "npi",
        match_key(F.col("address")).alias("address_key"),
        "state",
        "fips",
        *[number(F.col(name)).alias(name) for name in ("quality", "cost", "ma_util", "ffs_util")],
    )
    return _best(
        scores,
        ["npi", "address_key", "state", "fips"],
        ["quality", "cost", "ma_util", "ffs_util"],
    )


def specialty_list(names: DataFrame) -> DataFrame:
    """One-column specialty list to distinct matching keys and their trimmed names."""
    name = F.trim(F.col(names.columns[0]))
    return (
        names.select(F.upper(name).alias("specialty_key"), name.alias("specialty"))
        .where(F.col("specialty_key").isNotNull())
        .groupBy("specialty_key")
        .agg(F.min("specialty").alias("specialty"))
    )


def hospital_names(names: DataFrame) -> DataFrame:
    """Two-column name map to one display name per trimmed, upper-cased name."""
    source, display = names.columns
    return (
        names.select(
            match_key(F.col(source)).alias("name_key"), F.trim(F.col(display)).alias("facility")
        )
        .where(F.col("name_key").isNotNull())
        .groupBy("name_key")
        .agg(F.min("facility").alias("facility"))
    )


def market_rows(individual: DataFrame, hospital: DataFrame) -> DataFrame:
    """The two benchmark tables under one set of names, whole numbers as counts."""

    def rows(table: DataFrame, fips: str) -> DataFrame:
        return table.select(
            whole_number(F.col(fips)).alias("fips"),
            F.col("New Flag").alias("provider_type"),
            F.col("Scoring Category").alias("band"),
            *[
                whole_number(F.col(column)).alias(name)
                for column, name in (
                    ("Quality Score", "quality"),
                    ("Cost Score", "cost"),
                    ("MA Utilization Score", "utilization"),
                )
            ],
        )

    return rows(individual, "FIPS State County Code").unionByName(
        rows(hospital, "FIPS County Code")
    )
