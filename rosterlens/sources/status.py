"""What the sources of the requested networks held."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlens.sources.canonical import (
    INDIVIDUAL_KEY,
    ORGANIZATION_KEY,
    has_key,
    individual_is_reportable,
    organization_is_reportable,
    with_address_key,
)
from rosterlens.sources.requests import Requests

_COUNTS = ["n_rows", "n_reportable", "n_without_key"]


def _rows_per_network(
    rows: DataFrame, reportable: Column, key: list[str], source: str
) -> DataFrame:
    return (
        rows.groupBy("raw_network_id")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(reportable).alias("n_reportable"),
            F.count_if(reportable & ~has_key(key)).alias("n_without_key"),
        )
        .withColumn("source", F.lit(source))
    )


def _held(raw_individuals: DataFrame, raw_organizations: DataFrame) -> DataFrame:
    """Row counts per source and raw network."""
    return _rows_per_network(
        raw_individuals, individual_is_reportable(), INDIVIDUAL_KEY, "individual"
    ).unionByName(
        _rows_per_network(
            with_address_key(raw_organizations),
            organization_is_reportable(),
            ORGANIZATION_KEY,
            "organization",
        )
    )


def _status(asked: DataFrame, held: DataFrame, *first: str) -> DataFrame:
    sources = F.explode(F.array(F.lit("individual"), F.lit("organization"))).alias("source")
    both = asked.select("*", sources)
    return both.join(held, ["raw_network_id", "source"], "left").select(
        *first,
        "source",
        "raw_network_id",
        *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in _COUNTS],
        F.when(F.col("n_rows").isNull(), "missing").otherwise("read").alias("status"),
    )


def source_status(
    requests: Requests, raw_individuals: DataFrame, raw_organizations: DataFrame
) -> DataFrame:
    """Row counts per source and requested raw network; ``missing`` if it has no rows.

    Reportable rows pass the filters of their source; those of them with a null in a key
    column are left out of every comparison and counted in ``n_without_key``.
    """
    asked = requests.members.select("raw_network_id").distinct()
    return _status(asked, _held(raw_individuals, raw_organizations))


def request_source_status(
    requests: Requests, raw_individuals: DataFrame, raw_organizations: DataFrame
) -> DataFrame:
    """``source_status`` of the raw networks of every request, as an output of a run.

    The sources are grouped by network once, in the key columns only; requests meet the few
    grouped rows.
    """
    asked = requests.members.select("req_id", "raw_network_id").distinct()
    return _status(asked, _held(raw_individuals, raw_organizations), "req_id")
