"""Row-level exports with membership flags, scores and client-specific columns.

Each request belongs to a client profile, and a profile shows some columns and not others.
Columns a profile does not show are null in its rows, so that one pass can remove
duplicates for requests of every profile; ``export_view`` then picks the columns of one
pairing and names its flag columns after the two plans.

Duplicates go before rows are repeated for pairings: the wide rows are grouped once per profile,
of which there are four at most, with the networks that list them. A row then meets each of its
pairings once, at the smallest of its networks there, and the flags follow from what it carries,
so nothing is exchanged or grouped after the pairings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlens.functions.labels import yes_no
from rosterlens.functions.scores import score_text
from rosterlens.functions.text import (
    MISSING,
    confidence_label,
    group_name,
    group_tin,
    match_key,
    specialty_flag,
    text_or_missing,
    title_case,
    title_or_missing,
)
from rosterlens.operators.membership import (
    COUNTY_NAME_KEY,
    ORGANIZATION_COUNTY_NAME_KEY,
)
from rosterlens.operators.scoring import (
    INDIVIDUAL_SCORE_KEY,
    ORGANIZATION_SCORE_KEY,
    left_join_one,
    with_score_key,
)
from rosterlens.sources.canonical import HOSPITAL
from rosterlens.sources.requests import Requests

IN_BASE = "In Base Network"
IN_COMPARE = "In Compare Network"
FLAGS = [IN_BASE, IN_COMPARE]
# Whether a cost or quality score is known; orders the rows, not shown to any client.
IS_SCORED = "is_scored"

# Clients with a column set of their own; all others share the last set.
CLIENTS = [45, 8, 5]
DEFAULT = 0

ORGANIZATION_COLUMNS = [
    "Type",
    "NPI",
    "Presentation Name",
    "Address First Line",
    "Zip Code",
    "City",
    "State",
    "County",
    "FIPS State County Code",
    "Provider Type",
    "Specialty Name",
    *FLAGS,
    "Cost Score",
    "Quality Score",
    "FFS Utilization Score",
    "MA Utilization Score",
    "NPI Score Confidence",
]

INDIVIDUAL_COLUMNS = [
    "Type",
    "NPI",
    "First Name",
    "Last Name",
    "Presentation Name",
    "Address First Line",
    "Zip Code",
    "City",
    "State",
    "County",
    "FIPS State County Code",
    "Location Confidence Address level",
    "Location Confidence County Level",
    "Provider Type",
    "Specialty Name",
    "Specialty Flag",
    "Group TIN",
    "Group Name",
    *FLAGS,
    "NPI Score",
    "Cost Score",
    "Quality Score",
    "FFS Utilization Score",
    "MA Utilization Score",
    "NPI Score Confidence",
]

# Columns that only the listed profiles show; every other column is shown to all.
_ORGANIZATION_SHOWN = {
    "FFS Utilization Score": CLIENTS,
    "MA Utilization Score": CLIENTS,
}
_INDIVIDUAL_SHOWN = {
    "Address First Line": [8],
    "Location Confidence Address level": [8],
    "Location Confidence County Level": CLIENTS,
    "Specialty Flag": CLIENTS,
    "Group TIN": [8, 5],
    "Group Name": [8, 5],
    "Cost Score": CLIENTS,
    "Quality Score": CLIENTS,
    "FFS Utilization Score": CLIENTS,
    "MA Utilization Score": CLIENTS,
}


# What the pairings of a row follow from; formatting of the row happens before.
PLACE = ["raw_network_id", "fips", "places", "networks", "origin"]


def organization_columns(client_id: int) -> list[str]:
    return _columns(ORGANIZATION_COLUMNS, _ORGANIZATION_SHOWN, client_id)


def individual_columns(client_id: int) -> list[str]:
    return _columns(INDIVIDUAL_COLUMNS, _INDIVIDUAL_SHOWN, client_id)


def _columns(columns: list[str], shown: dict[str, list[int]], client_id: int) -> list[str]:
    return [c for c in columns if c not in shown or client_id in shown[c]]


def _mask(columns: list[str], shown: dict[str, list[int]]) -> list[Column]:
    """The columns, null in rows of profiles that are not shown them."""
    return [
        F.when(F.col("profile").isin(shown[c]), F.col(f"`{c}`")).alias(c)
        if c in shown
        else F.col(f"`{c}`")
        for c in columns
    ]


def _profile(client_id: Column) -> Column:
    return F.when(client_id.isin(CLIENTS), client_id).otherwise(F.lit(DEFAULT)).cast("int")


def _to_profiles(rows: DataFrame, requests: Requests) -> DataFrame:
    """Rows repeated for the profiles that ask for their network.

    Where the request tables are too large to be sent, rows go to all requested profiles instead
    of being exchanged by their network; those that are in no pairing there go with the pairings.
    """
    clients = requests.accepted.select("req_id", _profile(F.col("client_id")).alias("profile"))
    if requests.are_small:
        networks = requests.sides.join(requests.small(clients), "req_id")
        return rows.join(
            requests.small(networks.select("raw_network_id", "profile").distinct()), "raw_network_id"
        )
    # At most one per column set.
    profiles = sorted(row["profile"] for row in clients.select("profile").distinct().collect())
    return rows.withColumn("profile", F.explode(F.array(*[F.lit(p) for p in profiles]).cast("array<int>")))


def _listed_rows(
    rows: DataFrame, columns: list[str], shown: dict[str, list[int]], requests: Requests
) -> DataFrame:
    """One row per profile and shown columns, with its ``fips`` and ``listed``.

    ``listed`` has an entry for every provider key behind the row, mostly one: the networks that
    list the key, its places if it is in several counties, and the networks that list the row
    itself and whether with a score. All of it is made of the distinct requested networks and
    counties, so an entry does not grow with the rows of a provider, and partial aggregation
    collapses them before the shuffle.
    """
    shown_to = _to_profiles(rows, requests)
    listing = F.struct("origin", "raw_network_id", _is_scored().alias(IS_SCORED))
    grouped = (
        shown_to.select("profile", *PLACE, *_mask(columns, shown), listing.alias("listing"))
        .groupBy("profile", "fips", *[F.col(f"`{c}`") for c in columns])
        .agg(
            F.collect_set("listing").alias("listings"),
            F.collect_set(F.struct("origin", "networks", "places")).alias("origins"),
        )
    )

    def entry(origin: Column) -> Column:
        own = F.filter("listings", lambda x: x["origin"] == origin["origin"])
        return F.struct(
            origin["networks"].alias("networks"),
            origin["places"].alias("places"),
            F.transform(own, lambda x: x["raw_network_id"]).alias("by"),
            F.transform(F.filter(own, lambda x: x[IS_SCORED]), lambda x: x["raw_network_id"]).alias("scored_by"),
        )

    return grouped.withColumn("listed", F.transform("origins", entry)).drop("listings", "origins")


def _with_pairs(rows: DataFrame, requests: Requests) -> DataFrame:
    """Every row once for each pairing that contains it and each pair of flags it has there.

    The flags ask whether any listing of the provider in a requested county belongs to the
    base or compare network. Only a county name with several county codes needs the list of
    requested counties; otherwise all listings are in the county of the row. Provider keys that
    are shown alike give one row if their flags agree.
    """
    sides = requests.sides.select("req_id", "pair_idx", "raw_network_id")
    pairs = requests.pairs.select(
        "req_id",
        "pair_idx",
        "client_id",
        _profile(F.col("client_id")).alias("profile"),
        "base_raw",
        "compare_raw",
        F.array_union("base_raw", "compare_raw").alias("pair_raw"),
        F.col("counties").alias("pair_counties"),
    )

    def listed_in(entry: Column, side: str) -> Column:
        in_several_counties = F.exists(
            entry["places"],
            lambda place: F.array_contains(side, place["raw_network_id"])
            & F.array_contains("pair_counties", place["place_fips"]),
        )
        return yes_no(
            F.when(entry["places"].isNull(), F.arrays_overlap(entry["networks"], side)).otherwise(
                in_several_counties
            )
        )

    def flags(entry: Column) -> Column:
        return F.struct(
            listed_in(entry, "base_raw").alias(IN_BASE),
            listed_in(entry, "compare_raw").alias(IN_COMPARE),
            F.arrays_overlap(entry["scored_by"], "pair_raw").alias(IS_SCORED),
        )

    here = F.filter("listed", lambda entry: F.arrays_overlap(entry["by"], "pair_raw"))
    met = F.transform(here, flags)
    distinct = F.array_distinct(F.transform("met", lambda x: F.struct(x[IN_BASE], x[IN_COMPARE])))
    merged = F.transform(
        distinct,
        lambda x: F.struct(
            x[IN_BASE].alias(IN_BASE),
            x[IN_COMPARE].alias(IN_COMPARE),
            F.exists(
                "met",
                lambda y: (y[IN_BASE] == x[IN_BASE]) & (y[IN_COMPARE] == x[IN_COMPARE]) & y[IS_SCORED],
            ).alias(IS_SCORED),
        ),
    )
    own = [F.col(f"`{c}`") for c in rows.columns if c not in ("profile", "fips", "listed")]
    raw_networks = F.array_distinct(F.flatten("listed.by"))
    return (
        rows.withColumn("row_raw", raw_networks)
        .withColumn("raw_network_id", F.explode("row_raw"))
        .join(requests.small(sides), "raw_network_id")
        .join(requests.small(requests.counties), ["req_id", "fips"])
        .join(requests.small(pairs), ["req_id", "pair_idx", "profile"])
        .where(F.col("raw_network_id") == F.array_min(F.array_intersect("row_raw", "pair_raw")))
        .withColumn("met", met)
        .select("req_id", "pair_idx", "client_id", *own, F.inline(merged))
    )


def _one_per_row(
    rows: DataFrame, columns: list[str], shown: dict[str, list[int]], requests: Requests
) -> DataFrame:
    """Rows of every pairing without duplicates in the columns their client is shown."""
    own = [c for c in columns if c not in FLAGS]
    paired = _with_pairs(_listed_rows(rows, own, shown, requests), requests)
    return paired.select("req_id", "pair_idx", "client_id", *[F.col(f"`{c}`") for c in columns], IS_SCORED)


def _is_scored() -> Column:
    return (F.col("Quality Score") != MISSING) | (F.col("Cost Score") != MISSING)


def _telling(key: list[str]) -> list[str]:
    """The columns of a key, those first that tell most keys apart.

    Rows are sorted by the columns in turn, and those of one provider are alike in all but the last.
    """
    return [key[0], *reversed(key[1:])]


def _scored_places(
    rows: DataFrame, key: list[str], scores: DataFrame, score_on: list[str]
) -> DataFrame:
    """One narrow row per provider key, county and score key, with networks and scores.

    ``places`` are kept where a key is in several counties only; elsewhere networks tell all.

    Providers are reduced to keys before any join, so that neither the places nor the
    scores are joined to wide rows, and a provider with very many rows is one key here. Its
    set of places holds at most one entry per requested network, county and score key.
    """
    rest = [c for c in score_on if c not in (*key, "fips")]
    place = F.struct("raw_network_id", F.col("fips").alias("place_fips"), *rest)
    listed = rows.groupBy(*_telling(key)).agg(F.sort_array(F.collect_set(place)).alias("places"))

    def detail(place: Column) -> Column:
        return F.struct(place["place_fips"].alias("fips"), *[place[c].alias(c) for c in rest])

    # Most keys have one place, for which the functions of arrays need not run.
    one, only = F.size("places") == 1, F.col("places")[0]
    listed_at = F.transform("places", lambda p: F.struct(p["raw_network_id"], p["place_fips"]))
    in_several_counties = ~one & (F.size(F.array_distinct("places.place_fips")) > 1)
    narrow = (
        listed.select(
            *key,
            F.when(one, F.array(only["raw_network_id"]))
            .otherwise(F.array_distinct("places.raw_network_id"))
            .alias("networks"),
            F.when(in_several_counties, F.array_distinct(listed_at)).alias("places"),
            F.when(one, F.array(detail(only)))
            .otherwise(F.array_distinct(F.transform("places", detail)))
            .alias("details"),
        )
        .select(*key, "networks", "places", F.inline("details"))
    )
    return left_join_one(narrow, scores, score_on)


def _with_origin(rows: DataFrame) -> DataFrame:
    """``origin`` tells the keys apart that rows alike in all shown columns come from.

    It follows from the networks and places of the key, so it is made where rows are fewest.
    """
    networks = F.array_join(F.col("networks").cast("array<string>"), ",")
    both = F.when(F.col("places").isNull(), networks).otherwise(F.to_json(F.struct("networks", "places")))
    return rows.withColumn("origin", F.md5(both))


def _attach(rows: DataFrame, narrow: DataFrame, key: list[str]) -> DataFrame:
    """Join wide rows to their narrow row; county name and score key may be null.

    Both inputs are exchanged for this join, and nothing above it relies on the resulting
    partitioning, so adaptive execution splits the partition of a provider that holds a
    large share of the rows.
    """
    right = narrow.select(*[F.col(c).alias(f"_{c}") if c in key else c for c in narrow.columns])
    nullable = ("county_name", "score_key")
    condition = [
        F.col(c).eqNullSafe(F.col(f"_{c}")) if c in nullable else F.col(c) == F.col(f"_{c}")
        for c in _telling(key)
    ]
    return rows.join(right, condition, "inner").drop(*[f"_{c}" for c in key])


def with_facility_name(hospitals: DataFrame, names: DataFrame) -> DataFrame:
    """Display name of a hospital: the mapped name, or its own name in title case."""
    keyed = hospitals.withColumn("name_key", match_key(F.col("presentation_name")))
    return left_join_one(keyed, names, ["name_key"]).withColumn(
        "display_name", F.coalesce("facility", title_or_missing(F.col("name_key")))
    )


_HOSPITAL_COLUMNS = [
    *[c for c in PLACE if c != "origin"],
    "type",
    "npi",
    "presentation_name",
    "address",
    "zip_code",
    "city",
    "state",
    "county_name",
    "provider_type",
    "specialty",
    "quality",
    "cost",
    "ma_util",
    "ffs_util",
]


def hospital_rows(
    organizations: DataFrame, scores: DataFrame, names: DataFrame, requests: Requests
) -> DataFrame:
    """Formatted hospital rows of the requested networks, before columns and pairings."""
    # The membership key has the provider type, so other types do not matter here.
    hospitals = requests.restrict(organizations.where(F.col("provider_type") == HOSPITAL))
    key = ORGANIZATION_COUNTY_NAME_KEY
    narrow = _scored_places(hospitals, key, scores, ORGANIZATION_SCORE_KEY)
    # The specialty code is not shown; without it the rows of a hospital become few.
    scored = _attach(hospitals, narrow, [*key, "fips"]).select(*_HOSPITAL_COLUMNS).distinct()
    shown = with_facility_name(_with_origin(scored), names).select(
        *PLACE,
        F.col("type").alias("Type"),
        F.col("npi").alias("NPI"),
        F.col("display_name").alias("Presentation Name"),
        title_or_missing(F.trim("address")).alias("Address First Line"),
        text_or_missing(F.col("zip_code")).alias("Zip Code"),
        title_or_missing(F.col("city")).alias("City"),
        F.col("state").alias("State"),
        title_or_missing(F.col("county_name")).alias("County"),
        F.col("fips").alias("FIPS State County Code"),
        F.col("provider_type").alias("Provider Type"),
        F.col("specialty").alias("Specialty Name"),
        score_text(F.col("cost")).alias("Cost Score"),
        score_text(F.col("quality")).alias("Quality Score"),
        score_text(F.col("ffs_util")).alias("FFS Utilization Score"),
        score_text(F.col("ma_util")).alias("MA Utilization Score"),
        F.lit(MISSING).alias("NPI Score Confidence"),
    )
    return shown


def organization_export(hospitals: DataFrame, requests: Requests) -> DataFrame:
    """Hospitals of every pairing, from ``hospital_rows``, in the columns of their clients."""
    return _one_per_row(hospitals, ORGANIZATION_COLUMNS, _ORGANIZATION_SHOWN, requests)


def individual_rows(individuals: DataFrame, scores: DataFrame, requests: Requests) -> DataFrame:
    """Formatted individual rows of the requested networks, before columns and pairings."""
    rows = with_score_key(requests.restrict(individuals))
    key = COUNTY_NAME_KEY
    narrow = _with_origin(_scored_places(rows, key, scores, INDIVIDUAL_SCORE_KEY))
    scored = _attach(rows, narrow, [*key, "fips", "score_key"])
    shown = scored.select(
        *PLACE,
        F.col("type").alias("Type"),
        F.col("npi").alias("NPI"),
        title_or_missing(F.col("first_name")).alias("First Name"),
        title_or_missing(F.col("last_name")).alias("Last Name"),
        title_or_missing(F.col("presentation_name")).alias("Presentation Name"),
        title_or_missing(F.col("address")).alias("Address First Line"),
        text_or_missing(F.col("zip_code")).alias("Zip Code"),
        title_or_missing(F.col("city")).alias("City"),
        F.col("state").alias("State"),
        title_or_missing(F.col("county_name")).alias("County"),
        F.col("fips").alias("FIPS State County Code"),
        title_or_missing(F.col("location_confidence_address")).alias(
            "Location Confidence Address level"
        ),
        title_case(F.col("location_confidence")).alias("Location Confidence County Level"),
        F.col("provider_type").alias("Provider Type"),
        F.col("specialty").alias("Specialty Name"),
        specialty_flag(F.col("specialty_flag")).alias("Specialty Flag"),
        group_tin(F.col("group_tin")).alias("Group TIN"),
        group_name(F.col("group_name")).alias("Group Name"),
        score_text(F.col("npi_score")).alias("NPI Score"),
        score_text(F.col("cost")).alias("Cost Score"),
        score_text(F.col("quality")).alias("Quality Score"),
        score_text(F.col("ffs_util")).alias("FFS Utilization Score"),
        score_text(F.col("ma_util")).alias("MA Utilization Score"),
        confidence_label(F.col("colour")).alias("NPI Score Confidence"),
    )
    return shown


def hospitals_as_individuals(hospitals: DataFrame) -> DataFrame:
    """Hospital rows in the columns of the individual export."""
    return hospitals.select(
        "*",
        F.lit(MISSING).alias("First Name"),
        F.lit(MISSING).alias("Last Name"),
        F.lit("High").alias("Location Confidence Address level"),
        F.lit("High").alias("Location Confidence County Level"),
        specialty_flag(F.lit(None).cast("string")).alias("Specialty Flag"),
        F.lit(MISSING).alias("Group TIN"),
        F.lit(MISSING).alias("Group Name"),
        F.lit(MISSING).alias("NPI Score"),
    )


def individual_export(
    individuals: DataFrame, scores: DataFrame, hospitals: DataFrame, requests: Requests
) -> DataFrame:
    """Individuals, and the hospitals of ``hospital_rows``, in the columns of their clients."""
    rows = individual_rows(individuals, scores, requests).unionByName(
        hospitals_as_individuals(hospitals)
    )
    return _one_per_row(rows, INDIVIDUAL_COLUMNS, _INDIVIDUAL_SHOWN, requests)


def order_columns(export: DataFrame) -> list[Column]:
    """Scored rows first, then by NPI; the remaining columns settle ties."""
    first = ["NPI", "FIPS State County Code"]
    rest = [c for c in export.columns if c not in (*first, IS_SCORED)]
    return [F.col(IS_SCORED).desc(), *[F.col(f"`{c}`") for c in first + rest]]


def order_export(export: DataFrame) -> DataFrame:
    return export.orderBy(*order_columns(export))


def export_view(
    export: DataFrame, columns: list[str], base_name: str, compare_name: str
) -> DataFrame:
    """Columns of one profile with the flag columns named after the two plans."""
    if base_name == compare_name:
        compare_name = f"{compare_name} (compare)"
    names = {IN_BASE: base_name, IN_COMPARE: compare_name}
    return export.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in columns])
