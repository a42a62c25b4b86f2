"""The clean layer: providers and scores read, filtered and compacted once.

Requests then read this layer instead of thousands of small source files. Providers are
laid out by raw network and sorted by county, so a request reads only the folders of its
networks and skips row groups of other counties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.sources.files import Inputs
from rosterlens.sources.requests import Requests

_PROVIDERS = ("individuals", "organizations")
_SCORES = ("individual_scores", "organization_scores")
_TABLES = (*_PROVIDERS, *_SCORES, "specialties", "hospital_names", "market")


def _write_providers(rows: DataFrame, path: str) -> None:
    # Ranges over county and provider as well, so a very large network is many tasks.
    order = ["raw_network_id", "fips", "npi"]
    (
        rows.distinct()
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("raw_network_id")
        .parquet(path)
    )


def write_clean(inputs: Inputs, path: str) -> None:
    for name in _TABLES:
        table = getattr(inputs, name)
        if name in _PROVIDERS:
            _write_providers(table, f"{path}/{name}")
        elif name in _SCORES:
            by_county = table.repartitionByRange("fips", "npi").sortWithinPartitions("fips", "npi")
            by_county.write.mode("overwrite").parquet(f"{path}/{name}")
        else:
            table.write.mode("overwrite").parquet(f"{path}/{name}")


def read_clean(
    spark: SparkSession,
    path: str,
    raw_network_ids: list[int] | None = None,
    counties: list[int] | None = None,
    requests: Requests | None = None,
) -> Inputs:
    """The layer as inputs; of providers and scores only the given networks and counties.

    Lists become static filters: networks choose the folders that are listed, counties are pushed
    down to the row groups. With ``requests`` nothing is collected: every output joins the
    providers with the requested networks, and that join finds the folders when the job runs;
    scores and benchmarks are joined with the requested counties below their grouping.
    """

    def table(name: str) -> DataFrame:
        rows = spark.read.parquet(f"{path}/{name}")
        if name in _PROVIDERS:
            if raw_network_ids is not None:
                rows = rows.where(F.col("raw_network_id").isin(raw_network_ids))
            rows = rows.withColumn("raw_network_id", F.col("raw_network_id").cast("bigint"))
        if counties is not None and name in _PROVIDERS + _SCORES:
            rows = rows.where(F.col("fips").isin(counties))
        if requests is not None and name in (*_SCORES, "market"):
            rows = requests.in_counties(rows)
        return rows

    return Inputs(**{name: table(name) for name in _TABLES})
