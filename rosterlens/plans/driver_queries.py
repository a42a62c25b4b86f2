"""Queries on the driver tables, one per operator or report."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.functions import text
from rosterlens.functions.labels import pairing_label
from rosterlens.functions.scores import number, score_description
from rosterlens.functions.scores import score_text as export_text
from rosterlens.operators import counts, exports, indicators, membership, scoring
from rosterlens.session import prepare
from rosterlens.sources import canonical, requests
from rosterlens.sources import driver_tables as tables
from rosterlens.sources.status import source_status

_requests: dict[tuple[str, str], requests.Requests] = {}


def _request_tables(spark: SparkSession, sf_dir: str) -> requests.Requests:
    """The request tables, parsed once per session and data directory."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _requests:
        _requests[key] = tables.requests(spark, sf_dir)
    return _requests[key]


def scan_individuals(spark, sf_dir):
    return tables.individuals(spark, sf_dir).select(
        "raw_network_id",
        "npi",
        "state",
        "fips",
        "county_name",
        "provider_type",
        "specialty",
        "location_confidence",
        "zip_code",
        "group_tin",
    )


def scan_organizations(spark, sf_dir):
    return tables.organizations(spark, sf_dir).select(
        "raw_network_id",
        "npi",
        "address_key",
        "state",
        "fips",
        "provider_type",
        "specialty_code",
        "status",
        "parent_org",
        "specialty",
        "group_tin",
    )


def exclude_codes(spark, sf_dir):
    rows = tables.organizations(spark, sf_dir)
    kept = canonical.exclude_codes(rows, "specialty_code", tables.excluded_parts(spark, sf_dir))
    return kept.select("raw_network_id", "npi", "specialty_code", "provider_type")


def request_parse(spark, sf_dir):
    """Every order as a request: its priority is compared with two other networks."""
    orders = tables.table(spark, sf_dir, "orders")
    org = F.substring("o_orderpriority", 1, 1)
    entry = '{"parentOrganization":"Org","planBidIds":"H","networkIds":"%s"}'
    customer = F.col("o_custkey").cast("string")
    order = F.col("o_orderkey").cast("string")
    raw = orders.select(
        F.concat(customer, F.lit(", "), order, F.lit(","), customer).alias("county"),
        F.concat(F.lit("R"), order).alias("id"),
        F.lit("").alias("filespath"),
        F.lit("8").alias("clientID"),
        F.lit("").alias("userID"),
        F.concat(F.lit('{"'), org, F.lit('":' + entry % " 10, 11" + "}")).alias("base"),
        F.lit('{"7":' + entry % "70" + ',"8":' + entry % "80, 81" + "}").alias("compare"),
        F.concat(F.lit("Org "), org).alias("baseParentOrg"),
        F.lit("Org G| Org H").alias("compareParentOrg"),
        org.alias("baseParentOrgId"),
        F.when(F.col("o_orderstatus") == "P", "7").otherwise("7, 8").alias("compareParentOrgId"),
        F.lit("HMO").alias("planType"),
        F.lit("2").alias("planTypeId"),
    )
    parsed = requests.parse_requests(raw)
    accepted = F.col("reason").isNull()
    return parsed.select(
        "req_id",
        F.coalesce("reason", F.lit("accepted")).alias("outcome"),
        "base_id",
        F.size("counties").cast("bigint").alias("n_counties"),
        F.when(accepted, F.array_join("compare_ids", "|")).alias("compare_ids"),
        F.when(accepted, F.size(F.flatten("networks.raw_network_ids")).cast("bigint")).alias(
            "n_raw_networks"
        ),
        F.when(accepted, F.array_join("networks.network_name", "|")).alias("network_names"),
    )


def request_members(spark, sf_dir):
    """Requested rows by network: the bridge from raw networks to Network IDs."""
    request = _request_tables(spark, sf_dir)
    rows = request.restrict(tables.individuals(spark, sf_dir))
    return (
        rows.join(request.small(request.members), "raw_network_id")
        .join(request.small(request.counties), ["req_id", "fips"])
        .groupBy("req_id", "network_id", "network_name", "raw_network_id")
        .agg(F.count("*").alias("n_rows"))
    )


def county_filter(spark, sf_dir):
    request = _request_tables(spark, sf_dir)
    rows = request.restrict(tables.organizations(spark, sf_dir))
    return rows.groupBy("raw_network_id", "fips").agg(F.count("*").alias("n_rows"))


def specialty_filter(spark, sf_dir):
    rows = counts.listed_specialties(
        tables.individuals(spark, sf_dir), tables.specialties(spark, sf_dir)
    )
    return rows.select("raw_network_id", "npi", "fips", "specialty")


def score_dedup(spark, sf_dir):
    return tables.individual_scores(spark, sf_dir)


def score_dedup_organization(spark, sf_dir):
    return tables.organization_scores(spark, sf_dir)


def score_join_individual(spark, sf_dir):
    rows = tables.individuals(spark, sf_dir).select(
        "raw_network_id", "npi", "provider_type", "fips", "specialty"
    )
    return scoring.score_individuals(rows.distinct(), tables.individual_scores(spark, sf_dir))


def score_join_organization(spark, sf_dir):
    rows = tables.organizations(spark, sf_dir).select(
        "raw_network_id", "npi", "address_key", "state", "fips", "specialty_code"
    )
    return scoring.score_organizations(
        rows.distinct(), tables.organization_scores(spark, sf_dir)
    )


def facility_lookup(spark, sf_dir):
    rows = (
        tables.organizations(spark, sf_dir)
        .where(F.col("provider_type") == canonical.HOSPITAL)
        .select("npi", "presentation_name")
        .distinct()
    )
    return exports.with_facility_name(rows, tables.hospital_names(spark, sf_dir)).select(
        "npi", "display_name"
    )


def _flagged(spark, sf_dir, rows, key):
    request = _request_tables(spark, sf_dir)
    presence = membership.provider_presence(rows, key, request)
    return membership.network_sides(presence, request)


def flag_individual(spark, sf_dir):
    return _flagged(spark, sf_dir, tables.individuals(spark, sf_dir), canonical.INDIVIDUAL_KEY)


def flag_organization(spark, sf_dir):
    return _flagged(spark, sf_dir, tables.organizations(spark, sf_dir), canonical.ORGANIZATION_KEY)


def flag_specialty(spark, sf_dir):
    rows = counts.listed_specialties(
        tables.individuals(spark, sf_dir), tables.specialties(spark, sf_dir)
    )
    return _flagged(spark, sf_dir, rows, canonical.INDIVIDUAL_KEY)


def membership_individual(spark, sf_dir):
    return membership.membership_flags(
        tables.individuals(spark, sf_dir),
        membership.COUNTY_NAME_KEY,
        _request_tables(spark, sf_dir),
    )


def membership_organization(spark, sf_dir):
    return membership.membership_flags(
        tables.organizations(spark, sf_dir),
        membership.ORGANIZATION_COUNTY_NAME_KEY,
        _request_tables(spark, sf_dir),
    )


def membership_full_outer(spark, sf_dir):
    return membership.membership_by_outer_join(
        tables.individuals(spark, sf_dir),
        membership.COUNTY_NAME_KEY,
        _request_tables(spark, sf_dir),
    )


def common_semi_unique_anti(spark, sf_dir):
    return membership.common_and_unique(
        tables.individuals(spark, sf_dir),
        canonical.INDIVIDUAL_KEY,
        _request_tables(spark, sf_dir),
    )


def individual_counts(spark, sf_dir):
    return counts.individual_counts(
        tables.individuals(spark, sf_dir), _request_tables(spark, sf_dir)
    )


def organization_counts(spark, sf_dir):
    return counts.organization_counts(
        tables.organizations(spark, sf_dir), _request_tables(spark, sf_dir)
    )


def provider_counts(spark, sf_dir):
    return counts.provider_counts(
        tables.individuals(spark, sf_dir),
        tables.organizations(spark, sf_dir),
        _request_tables(spark, sf_dir),
        tables.SUPPRESSED_NETWORKS,
    )


def specialty_counts(spark, sf_dir):
    return counts.specialty_counts(
        tables.individuals(spark, sf_dir),
        tables.specialties(spark, sf_dir),
        _request_tables(spark, sf_dir),
    )


def count_grid(spark, sf_dir):
    """Organization counts with blank rows for the pairing that has no organizations."""
    return counts.fill_blank_pairings(
        organization_counts(spark, sf_dir),
        counts.organization_flags(),
        _request_tables(spark, sf_dir),
    )


def suppressed_placeholder(spark, sf_dir):
    """Organization counts with the blank rows of networks without hospital data."""
    request = _request_tables(spark, sf_dir)
    blank = counts.suppressed_rows(request, tables.SUPPRESSED_NETWORKS)
    return organization_counts(spark, sf_dir).unionByName(blank)


def score_bands(spark, sf_dir):
    return scoring.with_bands(tables.individual_scores(spark, sf_dir)).select(
        "npi",
        "provider_type",
        "fips",
        "score_key",
        "quality_band",
        "cost_band",
        "utilization_band",
    )


def _banded_networks(spark, sf_dir):
    rows = tables.individuals(spark, sf_dir).select(
        "raw_network_id", "npi", "provider_type", "fips", "specialty"
    )
    return scoring.with_bands(
        scoring.score_individuals(rows.distinct(), tables.individual_scores(spark, sf_dir))
    )


def band_counts(spark, sf_dir):
    return indicators.band_counts(
        _banded_networks(spark, sf_dir), ["raw_network_id", "provider_type"]
    )


def band_long(spark, sf_dir):
    return indicators.band_rows(
        _banded_networks(spark, sf_dir), ["raw_network_id", "provider_type"]
    )


def market_benchmark(spark, sf_dir):
    return indicators.market_benchmark(
        tables.market(spark, sf_dir), _request_tables(spark, sf_dir)
    )


def performance_indicators(spark, sf_dir):
    return indicators.performance_indicators(
        tables.individuals(spark, sf_dir),
        tables.individual_scores(spark, sf_dir),
        tables.organizations(spark, sf_dir),
        tables.organization_scores(spark, sf_dir),
        tables.market(spark, sf_dir),
        _request_tables(spark, sf_dir),
    )


def _hospital_rows(spark, sf_dir, request):
    return exports.hospital_rows(
        tables.organizations(spark, sf_dir),
        tables.organization_scores(spark, sf_dir),
        tables.hospital_names(spark, sf_dir),
        request,
    )


def _organization_export(spark, sf_dir, request):
    return exports.organization_export(_hospital_rows(spark, sf_dir, request), request)


def _individual_export(spark, sf_dir, request):
    return exports.individual_export(
        tables.individuals(spark, sf_dir),
        tables.individual_scores(spark, sf_dir),
        _hospital_rows(spark, sf_dir, request),
        request,
    )


def organization_export(spark, sf_dir):
    return _organization_export(spark, sf_dir, _request_tables(spark, sf_dir))


def individual_export(spark, sf_dir):
    return _individual_export(spark, sf_dir, _request_tables(spark, sf_dir))


def _view(export, spark, sf_dir, request_id, pair_idx, columns, base_name, compare_name):
    """One pairing of an export, which is worked out for the pairing's request only."""
    rows = export(spark, sf_dir, _request_tables(spark, sf_dir).of_request(request_id))
    pairing = rows.where((F.col("req_id") == request_id) & (F.col("pair_idx") == pair_idx))
    return exports.export_view(exports.order_export(pairing), columns, base_name, compare_name)


def export_client_8(spark, sf_dir):
    return _view(
        _individual_export,
        spark,
        sf_dir,
        "Req_1",
        2,
        exports.individual_columns(8),
        "Org A HMO",
        "Org E HMO",
    )


def export_client_45(spark, sf_dir):
    return _view(
        _individual_export,
        spark,
        sf_dir,
        "Req_2",
        1,
        exports.individual_columns(45),
        "Org C HMO",
        "Org A HMO",
    )


def export_client_5(spark, sf_dir):
    return _view(
        _individual_export,
        spark,
        sf_dir,
        "Req_3",
        2,
        exports.individual_columns(5),
        "Org E HMO",
        "Org B HMO",
    )


def export_client_other(spark, sf_dir):
    return _view(
        _individual_export,
        spark,
        sf_dir,
        "Req_4",
        1,
        exports.individual_columns(exports.DEFAULT),
        "Org D HMO",
        "Org C HMO",
    )


def organization_export_client_5(spark, sf_dir):
    return _view(
        _organization_export,
        spark,
        sf_dir,
        "Req_3",
        2,
        exports.organization_columns(5),
        "Org E HMO",
        "Org B HMO",
    )


def title_case(spark, sf_dir):
    part = tables.table(spark, sf_dir, "part")
    name = F.concat_ws("-", "p_name", "p_type", F.concat(F.col("p_size").cast("string"), "p_brand"))
    return part.select("p_partkey", text.title_case(name).alias("title"))


def text_normalise(spark, sf_dir):
    rows = tables.raw_individuals(spark, sf_dir)
    return (
        rows.select(
            "fips",
            text.group_tin(F.col("group_tin")).alias("group_tin"),
            text.group_name(F.col("group_name")).alias("group_name"),
            text.specialty_flag(F.col("specialty_flag")).alias("specialty_flag"),
            text.title_or_missing(F.col("last_name")).alias("last_name"),
            text.title_or_missing(F.col("location_confidence_address")).alias("confidence"),
            text.text_or_missing(F.col("zip_code")).alias("zip_code"),
        )
        .groupBy(
            "fips",
            "group_tin",
            "group_name",
            "specialty_flag",
            "last_name",
            "confidence",
            "zip_code",
        )
        .agg(F.count("*").alias("n_rows"))
    )


def score_text(spark, sf_dir):
    """Raw score texts as numbers and as export texts."""
    rows = tables.raw_individual_scores(spark, sf_dir)
    return (
        rows.select(
            "npi",
            export_text(number(F.col("quality"))).alias("quality"),
            export_text(number(F.col("cost"))).alias("cost"),
            text.confidence_label(F.col("colour")).alias("colour"),
        )
        .groupBy("npi", "quality", "cost", "colour")
        .agg(F.count("*").alias("n_rows"))
    )


def score_descriptions(spark, sf_dir):
    lineitem = tables.table(spark, sf_dir, "lineitem")
    grade = F.col("l_linenumber").cast("string")
    return (
        lineitem.select("l_returnflag", score_description(grade).alias("description"))
        .groupBy("l_returnflag", "description")
        .agg(F.count("*").alias("n_rows"))
    )


def pairing_labels(spark, sf_dir):
    """Labelled number of listed rows of every network in every pairing."""
    request = _request_tables(spark, sf_dir)
    return (
        tables.individuals(spark, sf_dir)
        .join(request.small(request.sides), "raw_network_id")
        .join(request.small(request.counties), ["req_id", "fips"])
        .select(
            "req_id",
            pairing_label(F.col("pair_idx"), F.col("in_base")).alias("base_compare"),
            "raw_network_id",
        )
        .groupBy("req_id", "base_compare", "raw_network_id")
        .agg(F.count("*").alias("n_rows"))
    )


def sources_of_requests(spark, sf_dir):
    return source_status(
        _request_tables(spark, sf_dir),
        tables.raw_individuals(spark, sf_dir),
        tables.raw_organizations(spark, sf_dir),
    )


def _prepared(query):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _prepared(f)
    for f in (
        scan_individuals,
        scan_organizations,
        exclude_codes,
        request_parse,
        request_members,
        county_filter,
        specialty_filter,
        score_dedup,
        score_dedup_organization,
        score_join_individual,
        score_join_organization,
        facility_lookup,
        flag_individual,
        flag_organization,
        flag_specialty,
        membership_individual,
        membership_organization,
        membership_full_outer,
        common_semi_unique_anti,
        individual_counts,
        organization_counts,
        provider_counts,
        specialty_counts,
        count_grid,
        suppressed_placeholder,
        score_bands,
        band_counts,
        band_long,
        market_benchmark,
        performance_indicators,
        organization_export,
        individual_export,
        export_client_8,
        export_client_45,
        export_client_5,
        export_client_other,
        organization_export_client_5,
        title_case,
        text_normalise,
        score_text,
        score_descriptions,
        pairing_labels,
        sources_of_requests,
    )
}
