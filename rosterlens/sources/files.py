"""Readers for the directory layout of provider, score, lookup and benchmark files.

    <root>/network_files/Individual/<raw_network_id>/<specialty_code>.parquet
    <root>/network_files/Organization/<raw_network_id>.csv
    <root>/*.csv
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rosterlens import schemas
from rosterlens.functions.scores import as_type, whole_number
from rosterlens.functions.text import match_key
from rosterlens.sources import canonical, catalogue, records
from rosterlens.sources.codes import excluded_codes
from rosterlens.sources.requests import Requests

INDIVIDUAL_DIR = "network_files/Individual"
ORGANIZATION_DIR = "network_files/Organization"

# File names of the score, lookup and benchmark tables. The names of the
# score files go on with the payer and its line of business.
INDIVIDUAL_SCORES_CSV = "Score for Individual*.csv"
ORGANIZATION_SCORES_CSV = "Scores for Organization*.csv"
SPECIALTIES_CSV = "HSD_specialty.csv"
HOSPITAL_NAMES_CSV = "Hospital_name_mapping.csv"
INDIVIDUAL_MARKET_CSV = "network_performance_countywise.csv"
HOSPITAL_MARKET_CSV = "network_performance_countywise_hospital.csv"

FILE_NAME = "__file_name"


@dataclass(frozen=True)
class Inputs:
    """Canonical tables one comparison reads."""

    individuals: DataFrame
    organizations: DataFrame
    individual_scores: DataFrame
    organization_scores: DataFrame
    specialties: DataFrame
    hospital_names: DataFrame
    market: DataFrame
    #: Provider rows as the files have them, where these are known; a run counts what they held.
    raw_individuals: DataFrame | None = None
    raw_organizations: DataFrame | None = None


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    marker: str | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All-text CSV by header name, so extra or re-ordered columns do no harm.

    With a marker, a column that every header has, the path may stand for many files: files are
    read in groups that share a header, and a column tells the file of a row. ``keep`` picks
    from the table of files by their ``path``. These files are cut into splits at true ends of
    records, so line breaks within cells do not keep a large file in one task. Without a marker
    line breaks need ``multi_line``, which reads a file in one task.
    """
    names = [F.col(f"`{n}`") for n in schema.fieldNames()]
    if marker is None:
        return spark.read.csv(path, header=True, escape='"', multiLine=multi_line).select(*names)
    empty = _empty(spark, StructType([*schema.fields, StructField(FILE_NAME, StringType())]))
    files = catalogue.file_table(spark, path)
    if files is None:
        raise FileNotFoundError(f"no such file: {path}")
    if keep is not None:
        files = keep(files)
    lengths = files.select(F.col("path").alias("of"), "length")
    found = catalogue.csv_headers(files, path)
    found = found.join(lengths, found["path"] == lengths["of"]).drop("of")
    groups = _by_header(found, marker)
    read = [_cells(spark, header, rows, path).select(*names, FILE_NAME) for header, rows in groups]
    return reduce(DataFrame.unionByName, read) if read else empty


def _by_header(headers: DataFrame, marker: str) -> list[tuple[list[str], list[tuple]]]:
    """Path, start of the data and length of the files of every header.

    One short row per file, as a file listing has. A file without the marker in its header is an
    error; empty files are left out.
    """
    groups: dict[tuple, list[tuple]] = {}
    for row in headers.where(F.size("header") > 0).orderBy("path").collect():
        if marker not in row["header"]:
            raise ValueError(f"no column {marker!r} in {row['path']}")
        file = (row["path"], row["body"], row["length"])
        groups.setdefault(tuple(row["header"]), []).append(file)
    return [(list(header), groups[header]) for header in sorted(groups)]


def _cells(spark: SparkSession, header: list[str], files: list[tuple], path: str) -> DataFrame:
    """The cells of files that share a header, as text, and the names of their files."""
    if not catalogue.is_reachable(path):
        rows = spark.read.csv([file[0] for file in files], header=True, escape='"', multiLine=True)
        return rows.select("*", F.col("_metadata.file_name").alias(FILE_NAME))
    # A name that comes twice is the first column of that name.
    names = [n if n not in header[:i] else f"{n}__{i}" for i, n in enumerate(header)]
    lines = records.records(spark.createDataFrame(files, "path string, body long, length long"))
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    row = F.from_csv("record", ddl, {"escape": '"'}).alias("row")
    file_name = F.element_at(F.split("path", "/"), -1).alias(FILE_NAME)
    return lines.select(row, file_name).select("row.*", FILE_NAME)


def scan_individuals(
    spark: SparkSession, root: str, raw_network_ids: list[int] | DataFrame | None = None
) -> DataFrame:
    """All individual files of the given raw networks (all networks by default).

    Networks may be a list or a table with a column ``raw_network_id``; a table is joined to the
    list of files. Excluded files and those of other networks are dropped from that list and never
    opened. Of the others the footers are read first, and files that store the columns with the
    same types are read together, so a column may be a number in one file and text in another, or
    be absent. Values become the declared type: a whole number is read from text, and from a
    double without a fraction; what cannot be read is null.
    """
    folder = f"{root}/{INDIVIDUAL_DIR}"
    files = catalogue.file_table(spark, folder, "*.parquet")
    if files is None:
        return _empty(spark, schemas.INDIVIDUALS)
    code = F.regexp_extract("path", r"/([^/]+)\.parquet$", 1)
    network = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)
    files = _of_networks(files.where(~code.isin(excluded_codes())), network, raw_network_ids)
    names = schemas.INDIVIDUAL_FILE.fieldNames()
    groups = catalogue.by_signature(catalogue.parquet_footers(files, folder, names))
    if not groups:
        return _empty(spark, schemas.INDIVIDUALS)
    read = [_declared(spark.read.parquet(*paths), present) for present, paths in groups]
    return reduce(DataFrame.unionByName, read).select(
        "raw_network_id",
        "npi",
        "type",
        "presentation_name",
        "first_name",
        "last_name",
        F.col("Address First Line").alias("address"),
        F.col("Parent_Organization").alias("parent_org"),
        "location_confidence",
        F.col("location_confidence_address_level").alias("location_confidence_address"),
        "specialty_category",
        "specialty_name",
        "specialty_subspecialty",
        "specialty_code",
        F.col("Specialty Flag").alias("specialty_flag"),
        F.col("New Flag").alias("provider_type"),
        "city",
        "state",
        "zip_code",
        "county_name",
        F.col("FIPS State County Code").alias("fips"),
        F.col("Specialty Description").alias("specialty"),
        F.col("Is_Dual_Provider").alias("is_dual_provider"),
        F.col("Affiliation ID").cast("string").alias("group_tin"),
        F.col("Affiliation Presentation Name").alias("group_name"),
    )


def _of_networks(files: DataFrame, network: Column, wanted: list[int] | DataFrame | None) -> DataFrame:
    """The files of the wanted networks."""
    if wanted is None:
        return files
    if isinstance(wanted, DataFrame):
        ids = wanted.select("raw_network_id").distinct()
        return files.join(ids, whole_number(network) == ids["raw_network_id"], "left_semi")
    return files.where(network.isin([str(i) for i in wanted]))


def _declared(rows: DataFrame, present: list[str]) -> DataFrame:
    """The declared columns of individual files and their network, from files that agree in types."""
    types = {field.name: field.dataType for field in rows.schema.fields}
    raw_network_id = F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+$", 1)
    return rows.select(
        whole_number(raw_network_id).alias("raw_network_id"),
        *[
            (
                as_type(F.col(f"`{field.name}`"), types[field.name], field.dataType)
                if field.name in present
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in schemas.INDIVIDUAL_FILE.fields
        ],
    )


def scan_organizations(
    spark: SparkSession, root: str, raw_network_ids: list[int] | DataFrame | None = None
) -> DataFrame:
    """Organization files of the given raw networks; a network without a file adds no rows."""
    folder = f"{root}/{ORGANIZATION_DIR}"
    try:
        files = _csv(
            spark,
            folder,
            schemas.ORGANIZATION_FILE,
            marker="FIPS State County Code",
            keep=lambda found: _of_networks(
                found.where(F.col("path").endswith(".csv")),
                F.regexp_extract("path", r"([^/]+)\.csv$", 1),
                raw_network_ids,
            ),
        )
    except FileNotFoundError:
        return _empty(spark, schemas.ORGANIZATIONS)
    raw_network_id = F.regexp_extract(FILE_NAME, r"^(.*)\.csv$", 1)
    return files.select(
        whole_number(raw_network_id).alias("raw_network_id"),
        whole_number(F.col("npi")).alias("npi"),
        "type",
        "presentation_name",
        "first_name",
        "last_name",
        F.col("Address First Line").alias("address"),
        match_key(F.col("Address First Line")).alias("address_key"),
        F.col("carrier_name").alias("parent_org"),
        "specialty_category",
        "specialty_name",
        "specialty_subspecialty",
        "specialty_code",
        F.col("New Flag").alias("provider_type"),
        "city",
        "state",
        "zip_code",
        "county_name",
        whole_number(F.col("FIPS State County Code")).alias("fips"),
        F.col("specialty_name").alias("specialty"),
        F.col("Status").alias("status"),
        F.lit(None).cast("string").alias("group_tin"),
        F.lit(None).cast("string").alias("group_name"),
    )


def individual_scores(
    spark: SparkSession, root: str, name: str = INDIVIDUAL_SCORES_CSV
) -> DataFrame:
    """Scores of the named file; a pattern reads all files it matches, each by its own header."""
    raw = _csv(spark, f"{root}/{name}", schemas.INDIVIDUAL_SCORE_FILE, marker="County FIPS")
    return canonical.individual_scores(
        raw.select(
            whole_number(F.col("NPI")).alias("npi"),
            F.col("New Flag").alias("provider_type"),
            whole_number(F.col("County FIPS")).alias("fips"),
            F.col("Specialty").alias("specialty"),
            F.col("Quality Score").alias("quality"),
            F.col("Cost Score").alias("cost"),
            F.col("MA Utilization Score").alias("ma_util"),
            F.col("FFS Utilization Score").alias("ffs_util"),
            F.col("NPI Score").alias("npi_score"),
            F.col("Quality color indicator").alias("colour"),
        )
    )


def organization_scores(
    spark: SparkSession, root: str, name: str = ORGANIZATION_SCORES_CSV
) -> DataFrame:
    """Scores of the named file; a pattern reads all files it matches, each by its own header."""
    raw = _csv(
        spark, f"{root}/{name}", schemas.ORGANIZATION_SCORE_FILE, marker="FIPS State County Code"
    )
    return canonical.organization_scores(
        raw.select(
            whole_number(F.col("npi")).alias("npi"),
            F.col("Address First Line").alias("address"),
            "state",
            whole_number(F.col("FIPS State County Code")).alias("fips"),
            F.col("Quality Score").alias("quality"),
            F.col("Cost Score").alias("cost"),
            F.col("MA Utilization Score").alias("ma_util"),
            F.col("FFS Utilization Score").alias("ffs_util"),
        )
    )


def specialties(spark: SparkSession, root: str) -> DataFrame:
    return canonical.specialty_list(
        _csv(spark, f"{root}/{SPECIALTIES_CSV}", schemas.SPECIALTY_FILE)
    )


def hospital_names(spark: SparkSession, root: str) -> DataFrame:
    return canonical.hospital_names(
        _csv(spark, f"{root}/{HOSPITAL_NAMES_CSV}", schemas.HOSPITAL_NAME_FILE, multi_line=True)
    )


def market(spark: SparkSession, root: str) -> DataFrame:
    return canonical.market_rows(
        _csv(spark, f"{root}/{INDIVIDUAL_MARKET_CSV}", schemas.INDIVIDUAL_MARKET_FILE),
        _csv(spark, f"{root}/{HOSPITAL_MARKET_CSV}", schemas.HOSPITAL_MARKET_FILE),
    )


def read_inputs(
    spark: SparkSession,
    root: str,
    raw_network_ids: list[int] | None = None,
    counties: list[int] | None = None,
    individual_scores_csv: str = INDIVIDUAL_SCORES_CSV,
    organization_scores_csv: str = ORGANIZATION_SCORES_CSV,
    requests: Requests | None = None,
) -> Inputs:
    """Every canonical table of one data directory.

    A folder that holds the scores of several payers needs the names of the two score files;
    by default all that match the pattern are read and the best score of a key counts.

    Lists of networks and counties are static filters: networks choose the files that are opened,
    and counties are pushed down to the provider files and below the grouping of the score rows.
    With ``requests`` nothing but the paths of the files is collected: their networks are joined
    to the list of files, and their counties to the rows.
    """
    networks = requests.raw_networks if requests is not None else raw_network_ids

    def in_counties(rows: DataFrame) -> DataFrame:
        if requests is not None:
            rows = requests.in_counties(rows)
        return rows if counties is None else rows.where(F.col("fips").isin(counties))

    raw_individuals = scan_individuals(spark, root, networks)
    raw_organizations = scan_organizations(spark, root, networks)
    return Inputs(
        raw_individuals=raw_individuals,
        raw_organizations=raw_organizations,
        individuals=in_counties(canonical.clean_individuals(raw_individuals)),
        organizations=in_counties(canonical.clean_organizations(raw_organizations)),
        individual_scores=in_counties(individual_scores(spark, root, individual_scores_csv)),
        organization_scores=in_counties(organization_scores(spark, root, organization_scores_csv)),
        specialties=specialties(spark, root),
        hospital_names=hospital_names(spark, root),
        market=in_counties(market(spark, root)),
    )
