"""Score-band counts of networks and of the market.

As with the counts, providers that are listed in the same places and fall in the same
bands are counted together before requests are applied to the grouped rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.scores import BANDS, NO_BAND
from rosterlens.operators.membership import listings
from rosterlens.operators.scoring import score_individuals, score_organizations, with_bands
from rosterlens.schemas import INDICATOR_COLUMNS
from rosterlens.sources.canonical import HOSPITAL
from rosterlens.sources.requests import Requests

MEASURES = ["quality", "cost", "utilization"]

# Extra listings of a provider that agree in these columns do not count again.
INDIVIDUAL_ROW = ["npi", "state", "fips", "provider_type", "specialty", "location_confidence"]
ORGANIZATION_ROW = ["npi", "state", "fips", "provider_type", "address_key", "specialty_code"]


def _long_bands(wide: DataFrame, keys: list[str]) -> DataFrame:
    """One row per band from columns such as ``quality_High``."""
    rows = F.array(
        *[
            F.struct(
                *[F.col(f"{measure}_{band}").alias(measure) for measure in MEASURES],
                F.lit(band).alias("band"),
            )
            for band in BANDS
        ]
    )
    return wide.select(*keys, F.inline(rows))


def band_counts(bands: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """All measures and bands counted in one pass, one wide row per group."""
    n = F.col(weight) if weight else F.lit(1)
    return bands.groupBy(*keys).agg(
        *[
            F.coalesce(
                F.sum(F.when(F.col(f"{measure}_band") == band, n)), F.lit(0).cast("bigint")
            ).alias(f"{measure}_{band}")
            for measure in MEASURES
            for band in BANDS
        ]
    )


def band_rows(bands: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """The counts of ``band_counts`` with one row per group and band."""
    return _long_bands(band_counts(bands, keys, weight), keys)


def _network_bands(scored: DataFrame, requests: Requests) -> DataFrame:
    """Band rows of every network of every request, each network once per request."""
    band_columns = [f"{measure}_band" for measure in MEASURES]
    same = ["provider_type", "places", *band_columns]
    alike = with_bands(scored).groupBy(*same).agg(F.count("*").alias("n"))
    keys = ["req_id", "network_id", "network_name", "provider_type"]
    per_network = (
        alike.select(*same, "n", F.inline("places"))
        .join(requests.small(requests.members), "raw_network_id")
        .join(
            requests.small(requests.counties.withColumnRenamed("fips", "place_fips")),
            ["req_id", "place_fips"],
        )
        # A network that spans several raw networks lists a provider once.
        .select("req_id", "network_id", "network_name", *same, "n")
        .distinct()
    )
    return band_rows(per_network, keys, "n")


def individual_bands(individuals: DataFrame, scores: DataFrame, requests: Requests) -> DataFrame:
    listed = listings(requests.restrict(individuals), INDIVIDUAL_ROW)
    return _network_bands(score_individuals(listed, scores), requests)


def hospital_bands(organizations: DataFrame, scores: DataFrame, requests: Requests) -> DataFrame:
    hospitals = organizations.where(F.col("provider_type") == HOSPITAL)
    listed = listings(requests.restrict(hospitals), ORGANIZATION_ROW)
    return _network_bands(score_organizations(listed, scores), requests)


def market_benchmark(market: DataFrame, requests: Requests) -> DataFrame:
    """Totals of the benchmark over the counties of each request."""
    return (
        market.where(F.col("band") != NO_BAND)
        .join(requests.small(requests.counties), "fips")
        .groupBy("req_id", "provider_type", "band")
        .agg(*[F.coalesce(F.sum(m), F.lit(0).cast("bigint")).alias(m) for m in MEASURES])
        .withColumn("network_id", F.lit(""))
        .withColumn("network_name", F.lit("Common Counties"))
    )


def _report(bands: DataFrame) -> DataFrame:
    return bands.select(
        "req_id",
        "network_id",
        "network_name",
        F.col("quality").alias("Quality Score"),
        F.col("cost").alias("Cost Score"),
        F.col("utilization").alias("Utilization Score"),
        F.col("provider_type").alias("New Flag"),
        F.col("band").alias("Scoring Category"),
    ).select(*INDICATOR_COLUMNS)


def performance_indicators(
    individuals: DataFrame,
    individual_scores: DataFrame,
    organizations: DataFrame,
    organization_scores: DataFrame,
    market: DataFrame,
    requests: Requests,
) -> DataFrame:
    """Band counts of individuals and hospitals per network, with the market totals."""
    return (
        _report(individual_bands(individuals, individual_scores, requests))
        .unionByName(_report(hospital_bands(organizations, organization_scores, requests)))
        .unionByName(_report(market_benchmark(market, requests)))
    )
