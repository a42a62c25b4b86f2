"""Which networks hold a provider: the common/unique test of every pairing at once.

Providers are first collapsed to one row per key with the set of (raw network, county)
places that list them. That is the only shuffle of provider data, and its volume does not
depend on how many requests or pairings are asked for. A set holds at most one entry per
requested raw network and county of the key, and partial aggregation keeps a key with very
many source rows small before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.labels import pairing_label, yes_no
from rosterlens.sources.requests import Requests

COUNTY_NAME_KEY = ["npi", "state", "county_name", "provider_type"]
ORGANIZATION_COUNTY_NAME_KEY = [
    "npi",
    "state",
    "county_name",
    "address_key",
    "provider_type",
    "specialty_code",
]


def listings(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row per key with the sorted set of places that list it."""
    place = F.struct("raw_network_id", F.col("fips").alias("place_fips"))
    return rows.groupBy(*key).agg(F.sort_array(F.collect_set(place)).alias("places"))


def pair_presence(listed: DataFrame, group: list[str], requests: Requests) -> DataFrame:
    """Presence of each group in the base and compare network of every pairing.

    ``listed`` has the ``group`` columns and their ``places``. Spark keeps the partitioning
    by ``group`` through the broadcast joins, so the final grouping moves no data.
    """
    return (
        listed.select(*group, F.inline("places"))
        .join(requests.small(requests.sides), "raw_network_id")
        .join(
            requests.small(requests.counties.withColumnRenamed("fips", "place_fips")),
            ["req_id", "place_fips"],
        )
        .groupBy("req_id", "pair_idx", *group)
        .agg(
            F.bool_or("in_base").alias("in_base"),
            F.bool_or("in_compare").alias("in_compare"),
            F.bool_and("two_networks").alias("two_networks"),
        )
        .withColumn(
            "is_common", F.col("in_base") & F.col("in_compare") & F.col("two_networks")
        )
        .drop("two_networks")
    )


def key_presence(listed: DataFrame, key: list[str], requests: Requests) -> DataFrame:
    """Presence of each key in every pairing, for many keys with few places each.

    A key meets a pairing at each of its places there. The first of them stands for all, and the
    flags follow from the places the key carries, so nothing is grouped after the pairings: a
    task holds the keys, not the keys times their pairings. Only a key in several counties needs
    the list of requested counties; elsewhere the county was met by the join.
    """
    pairs = requests.pairs.select(
        "req_id",
        "pair_idx",
        (F.col("base_id") != F.col("compare_id")).alias("two_networks"),
        "base_raw",
        "compare_raw",
        F.array_union("base_raw", "compare_raw").alias("pair_raw"),
        F.col("counties").alias("pair_counties"),
    )
    counties = requests.counties.withColumnRenamed("fips", "place_fips")
    in_one_county = F.element_at("places.place_fips", 1) == F.array_min("places.place_fips")
    in_one_county &= F.element_at("places.place_fips", 1) == F.array_max("places.place_fips")
    here = F.filter(
        "places",
        lambda place: F.array_contains("pair_raw", place["raw_network_id"])
        & (in_one_county | F.array_contains("pair_counties", place["place_fips"])),
    )

    def any_of(side: str) -> Column:
        return F.arrays_overlap("here.raw_network_id", side)

    return (
        listed.select(*key, "places", F.inline("places"))
        .join(requests.small(requests.sides.select("req_id", "pair_idx", "raw_network_id")), "raw_network_id")
        .join(requests.small(counties), ["req_id", "place_fips"])
        .join(requests.small(pairs), ["req_id", "pair_idx"])
        .withColumn("here", F.when(F.size("places") == 1, F.col("places")).otherwise(here))
        .where(F.col("here")[0] == F.struct("raw_network_id", "place_fips"))
        .select(
            "req_id",
            "pair_idx",
            *key,
            any_of("base_raw").alias("in_base"),
            any_of("compare_raw").alias("in_compare"),
            "two_networks",
        )
        .withColumn(
            "is_common", F.col("in_base") & F.col("in_compare") & F.col("two_networks")
        )
        .drop("two_networks")
    )


def provider_presence(rows: DataFrame, key: list[str], requests: Requests) -> DataFrame:
    """Presence per pairing and provider key."""
    return key_presence(listings(requests.restrict(rows), key), key, requests)


def network_sides(presence: DataFrame, requests: Requests) -> DataFrame:
    """One row per network that holds the provider, named and labelled for its pairing."""
    names = requests.pairs.select(
        "req_id", "pair_idx", "base_id", "base_name", "compare_id", "compare_name"
    )
    base = F.struct(
        F.col("base_id").alias("network_id"),
        F.col("base_name").alias("network_name"),
        pairing_label(F.col("pair_idx"), F.lit(True)).alias("base_compare"),
        F.col("in_base").alias("listed"),
    )
    compare = F.struct(
        F.col("compare_id").alias("network_id"),
        F.col("compare_name").alias("network_name"),
        pairing_label(F.col("pair_idx"), F.lit(False)).alias("base_compare"),
        (F.col("in_compare") & (F.col("base_id") != F.col("compare_id"))).alias("listed"),
    )
    rest = [c for c in presence.columns if c not in ("in_base", "in_compare", "is_common")]
    return (
        presence.join(requests.small(names), ["req_id", "pair_idx"])
        .select(*rest, "is_common", F.inline(F.array(base, compare)))
        .where("listed")
        .select(
            *rest,
            "network_id",
            "network_name",
            "base_compare",
            F.when(F.col("is_common"), "common").otherwise("unique").alias("common_unique"),
        )
    )


def membership_flags(rows: DataFrame, key: list[str], requests: Requests) -> DataFrame:
    """Y/N flags per pairing and provider key."""
    presence = provider_presence(rows, key, requests)
    return presence.select(
        "req_id",
        "pair_idx",
        *key,
        yes_no(F.col("in_base")).alias("in_base"),
        yes_no(F.col("in_compare")).alias("in_compare"),
    )


def _side_keys(rows: DataFrame, key: list[str], requests: Requests, side: str) -> DataFrame:
    """Distinct provider keys of one side of every pairing."""
    sides = requests.sides.where(side).select("req_id", "pair_idx", "raw_network_id")
    return (
        rows.join(requests.small(sides), "raw_network_id")
        .join(requests.small(requests.counties), ["req_id", "fips"])
        .select("req_id", "pair_idx", *key)
        .distinct()
    )


def membership_by_outer_join(rows: DataFrame, key: list[str], requests: Requests) -> DataFrame:
    """The Y/N flags by a full outer join of both sides; an independent second way."""
    full_key = ["req_id", "pair_idx", *key]
    base = _side_keys(rows, key, requests, "in_base").withColumn("in_base", F.lit("Y"))
    compare = _side_keys(rows, key, requests, "in_compare").withColumn("in_compare", F.lit("Y"))
    return base.join(compare, full_key, "full_outer").select(
        *full_key,
        F.coalesce("in_base", F.lit("N")).alias("in_base"),
        F.coalesce("in_compare", F.lit("N")).alias("in_compare"),
    )


def common_and_unique(rows: DataFrame, key: list[str], requests: Requests) -> DataFrame:
    """Base providers split by semi and anti join into common and unique ones."""
    full_key = ["req_id", "pair_idx", *key]
    base = _side_keys(rows, key, requests, "in_base")
    compare = _side_keys(rows, key, requests, "in_compare and two_networks")
    common = base.join(compare, full_key, "left_semi").withColumn("common_unique", F.lit("common"))
    unique = base.join(compare, full_key, "left_anti").withColumn("common_unique", F.lit("unique"))
    return common.unionByName(unique)
