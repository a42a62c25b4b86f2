"""Distinct-provider counts by network, provider type or specialty, common and unique.

Providers listed in the same places give the same answer in every pairing. They are
therefore counted per distinct set of places first, and requests and pairings are applied
to those few grouped rows instead of to the providers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.labels import pairing_label
from rosterlens.operators.membership import listings, pair_presence
from rosterlens.schemas import COUNT_COLUMNS
from rosterlens.sources.canonical import (
    HOSPITAL,
    INDIVIDUAL_KEY,
    INDIVIDUAL_TYPES,
    ORGANIZATION_KEY,
)
from rosterlens.sources.requests import Requests

# Fixed value: raw networks that have no hospital data source.
SUPPRESSED_NETWORKS = [208546]


def _label_counts(counts: DataFrame, requests: Requests) -> DataFrame:
    """Three counts per pairing and flag to one row per network and common/unique.

    A common provider is in both networks, so both report the same common count.
    """
    names = requests.pairs.select(
        "req_id", "pair_idx", "base_id", "base_name", "compare_id", "compare_name"
    )

    def row(side: str, kind: str, count: str):
        return F.struct(
            F.col(f"{side}_id").alias("network_id"),
            F.col(f"{side}_name").alias("network_name"),
            F.lit(kind).alias("common_unique"),
            pairing_label(F.col("pair_idx"), F.lit(side == "base")).alias("base_compare"),
            F.col(count).alias("npi_count"),
        )

    two_networks = F.array(
        row("base", "common", "base_common"),
        row("base", "unique", "base_unique"),
        row("compare", "common", "compare_common"),
        row("compare", "unique", "compare_unique"),
    )
    one_network = F.array(row("base", "unique", "base_unique"))
    rows = F.when(F.col("base_id") == F.col("compare_id"), one_network).otherwise(two_networks)
    return (
        counts.join(requests.small(names), ["req_id", "pair_idx"])
        .select("req_id", "flag", F.inline(rows))
        .where("npi_count > 0")
        .select(*COUNT_COLUMNS)
    )


def _key_counts(rows: DataFrame, key: list[str], requests: Requests) -> DataFrame:
    """Counts by provider type of keys that contain the provider type, state and county.

    Such a key is exactly the provider plus the columns of the distinct count, so counting
    keys is counting distinct providers, and counties add up.
    """
    group = ["provider_type", "places", "n"]
    alike = (
        listings(requests.restrict(rows), key)
        .groupBy("provider_type", "places")
        .agg(F.count("*").alias("n"))
    )
    both = F.col("is_common")
    counted = (
        pair_presence(alike, group, requests)
        .groupBy("req_id", "pair_idx", F.col("provider_type").alias("flag"))
        .agg(
            F.sum(F.when(both, F.col("n"))).alias("base_common"),
            F.sum(F.when(both, F.col("n"))).alias("compare_common"),
            F.sum(F.when(F.col("in_base") & ~both, F.col("n"))).alias("base_unique"),
            F.sum(F.when(F.col("in_compare") & ~both, F.col("n"))).alias("compare_unique"),
        )
    )
    return _label_counts(counted, requests)


def individual_counts(individuals: DataFrame, requests: Requests) -> DataFrame:
    return _key_counts(individuals, INDIVIDUAL_KEY, requests)


def organization_counts(organizations: DataFrame, requests: Requests) -> DataFrame:
    return _key_counts(organizations, ORGANIZATION_KEY, requests)


def suppressed_rows(requests: Requests, suppressed: list[int] = SUPPRESSED_NETWORKS) -> DataFrame:
    """A hospital row without a count for networks that have no hospital data at all.

    A network is suppressed only if all of its raw networks are.
    """
    listed = F.array(*[F.lit(i).cast("bigint") for i in suppressed])

    def side(name: str):
        return F.struct(
            F.col(f"{name}_id").alias("network_id"),
            F.col(f"{name}_name").alias("network_name"),
            pairing_label(F.col("pair_idx"), F.lit(name == "base")).alias("base_compare"),
            (F.size(F.array_except(f"{name}_raw", listed)) == 0).alias("is_suppressed"),
        )

    two_networks = F.col("base_id") != F.col("compare_id")
    sides = F.when(two_networks, F.array(side("base"), side("compare"))).otherwise(
        F.array(side("base"))
    )
    return (
        requests.pairs.select("req_id", F.inline(sides))
        .where("is_suppressed")
        .withColumn("common_unique", F.lit(None).cast("string"))
        .withColumn("flag", F.lit(HOSPITAL))
        .withColumn("npi_count", F.lit(None).cast("bigint"))
        .select(*COUNT_COLUMNS)
    )


def provider_counts(
    individuals: DataFrame,
    organizations: DataFrame,
    requests: Requests,
    suppressed: list[int] = SUPPRESSED_NETWORKS,
) -> DataFrame:
    """Counts by provider type for individuals and organizations of every pairing."""
    return (
        individual_counts(individuals, requests)
        .unionByName(organization_counts(organizations, requests))
        .unionByName(suppressed_rows(requests, suppressed))
    )


def listed_specialties(individuals: DataFrame, specialties: DataFrame) -> DataFrame:
    """Individuals whose specialty is on the allow-list, compared without case."""
    listed = specialties.select("specialty_key")
    return (
        individuals.withColumn("specialty_key", F.upper("specialty"))
        .join(listed, "specialty_key", "left_semi")
        .drop("specialty_key")
    )


def specialty_counts(
    individuals: DataFrame, specialties: DataFrame, requests: Requests
) -> DataFrame:
    """Counts by allow-listed specialty.

    A provider is common if both networks list it under the same provider type with any
    allow-listed specialty, not necessarily the same one. A provider with one specialty
    under two provider types is counted once for each of common and unique.
    """
    rows = requests.restrict(listed_specialties(individuals, specialties))
    entry = F.struct("provider_type", "specialty", "raw_network_id")
    alike = (
        rows.groupBy("npi", "state", "fips")
        .agg(F.sort_array(F.collect_set(entry)).alias("entries"))
        .groupBy("fips", "entries")
        .agg(F.count("*").alias("n"))
    )
    same = ["req_id", "pair_idx", "fips", "entries", "n"]
    listing = F.struct("specialty", "in_base", "in_compare")
    by_type = (
        alike.select("fips", "entries", "n", F.inline("entries"))
        .join(requests.small(requests.sides), "raw_network_id")
        .join(requests.small(requests.counties), ["req_id", "fips"])
        .groupBy(*same, "provider_type")
        .agg(
            (F.bool_or("in_base") & F.bool_or("in_compare") & F.bool_and("two_networks")).alias(
                "is_common"
            ),
            F.collect_set(listing).alias("listings"),
        )
    )
    common = F.col("is_common")
    kinds = {
        "base_common": F.col("in_base") & common,
        "base_unique": F.col("in_base") & ~common,
        "compare_common": F.col("in_compare") & common,
        "compare_unique": F.col("in_compare") & ~common,
    }
    counted = (
        by_type.select(*same, "is_common", F.inline("listings"))
        .groupBy(*same, "specialty")
        .agg(*[F.bool_or(present).alias(kind) for kind, present in kinds.items()])
        .groupBy("req_id", "pair_idx", F.col("specialty").alias("flag"))
        .agg(*[F.sum(F.when(F.col(kind), F.col("n"))).alias(kind) for kind in kinds])
    )
    return _label_counts(counted, requests)


def individual_flags() -> Column:
    return F.array(*[F.lit(t) for t in INDIVIDUAL_TYPES])


def organization_flags() -> Column:
    return F.array(F.lit(HOSPITAL))


def specialty_flags(specialties: DataFrame) -> Column:
    """The allow-listed names as one array, read by a scalar subquery."""
    return specialties.agg(F.sort_array(F.collect_set("specialty"))).scalar()


def fill_blank_pairings(counts: DataFrame, flags: Column, requests: Requests) -> DataFrame:
    """Add rows without a count for pairings that have no row at all in ``counts``.

    ``counts`` holds one category (individuals, organizations or specialties) and ``flags``
    is the array of its flags; each network of the pairing gets a common and a unique row
    per flag.
    """

    def side(name: str):
        return F.struct(
            F.col(f"{name}_id").alias("network_id"),
            F.col(f"{name}_name").alias("network_name"),
            pairing_label(F.col("pair_idx"), F.lit(name == "base")).alias("base_compare"),
        )

    pairing = F.regexp_replace("base_compare", "^base_", "").alias("pairing")
    sides = F.when(
        F.col("base_id") != F.col("compare_id"), F.array(side("base"), side("compare"))
    ).otherwise(F.array(side("base")))
    grid = (
        requests.pairs.select("req_id", F.inline(sides))
        .select("*", F.explode(flags).alias("flag"))
        .select("*", F.explode(F.array(F.lit("common"), F.lit("unique"))).alias("common_unique"))
        .select("*", pairing, F.lit(None).cast("bigint").alias("npi_count"))
    )
    present = counts.select("req_id", pairing).distinct()
    blank = grid.join(present, ["req_id", "pairing"], "left_anti")
    return counts.unionByName(blank.select(*COUNT_COLUMNS))
