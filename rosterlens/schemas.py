"""Declared schemas of the source files and the column lists of the outputs."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _schema(columns: str, **special) -> StructType:
    """Comma list of column names, strings unless a type is named."""
    names = [name.strip() for name in columns.split(",")]
    return StructType([StructField(n, special.get(n, StringType())) for n in names])


_LONG = {"npi": LongType(), "network_id": LongType(), "FIPS State County Code": LongType()}

INDIVIDUAL_FILE = _schema(
    "npi, type, presentation_name, first_name, last_name, network_id, network_name, "
    "Address First Line, Parent_Organization, location_confidence, "
    "location_confidence_address_level, specialty_category, specialty_name, "
    "specialty_subspecialty, specialty_code, Specialty Flag, New Flag, city, state, zip_code, "
    "county_name, FIPS State County Code, Specialty Description, Is_Dual_Provider, "
    "Affiliation ID, Affiliation Presentation Name",
    **_LONG,
    **{"Affiliation ID": LongType()},
)

# CSV columns are read as text and cast on the way in, so that a bad cell is a null
# and zip codes keep their leading zeros.
ORGANIZATION_FILE = _schema(
    "npi, type, presentation_name, first_name, last_name, network_id, network_name, "
    "carrier_name, specialty_category, specialty_name, specialty_subspecialty, specialty_code, "
    "New Flag, city, state, zip_code, county_name, FIPS State County Code, Address First Line, "
    "Status"
)

INDIVIDUAL_SCORE_FILE = _schema(
    "NPI, New Flag, County FIPS, Cost Score, Quality Score, Specialty, NPI Score, "
    "MA Utilization Score, FFS Utilization Score, Quality color indicator"
)

ORGANIZATION_SCORE_FILE = _schema(
    "npi, Address First Line, state, FIPS State County Code, Quality Score, Cost Score, "
    "FFS Utilization Score, MA Utilization Score"
)

SPECIALTY_FILE = _schema("Specialty Description")
HOSPITAL_NAME_FILE = _schema("Presentation Name, AHD_Facility Name")

INDIVIDUAL_MARKET_FILE = _schema(
    "state, county_name, FIPS State County Code, New Flag, Scoring Category, Quality Score, "
    "Cost Score, MA Utilization Score, FFS Utilization Score"
)
HOSPITAL_MARKET_FILE = _schema(
    "state, county_name, FIPS County Code, New Flag, Scoring Category, Quality Score, "
    "Cost Score, MA Utilization Score, FFS Utilization Score"
)

# One row per request, as text, in the order of the request's thirteen arguments.
REQUEST = _schema(
    "county, id, filespath, clientID, userID, base, compare, baseParentOrg, compareParentOrg, "
    "baseParentOrgId, compareParentOrgId, planType, planTypeId"
)

INDIVIDUALS = _schema(
    "raw_network_id, npi, type, presentation_name, first_name, last_name, address, parent_org, "
    "location_confidence, location_confidence_address, specialty_category, specialty_name, "
    "specialty_subspecialty, specialty_code, specialty_flag, provider_type, city, state, "
    "zip_code, county_name, fips, specialty, is_dual_provider, group_tin, group_name",
    raw_network_id=LongType(),
    npi=LongType(),
    fips=LongType(),
)

ORGANIZATIONS = _schema(
    "raw_network_id, npi, type, presentation_name, first_name, last_name, address, address_key, "
    "parent_org, specialty_category, specialty_name, specialty_subspecialty, specialty_code, "
    "provider_type, city, state, zip_code, county_name, fips, specialty, status, group_tin, "
    "group_name",
    raw_network_id=LongType(),
    npi=LongType(),
    fips=LongType(),
)

_SCORES = {
    name: DoubleType() for name in ("quality", "cost", "ma_util", "ffs_util", "npi_score")
}
INDIVIDUAL_SCORES = _schema(
    "npi, provider_type, fips, score_key, quality, cost, ma_util, ffs_util, npi_score, colour",
    npi=LongType(),
    fips=LongType(),
    **_SCORES,
)
ORGANIZATION_SCORES = _schema(
    "npi, address_key, state, fips, quality, cost, ma_util, ffs_util",
    npi=LongType(),
    fips=LongType(),
    **_SCORES,
)

COUNT_COLUMNS = [
    "req_id",
    "network_id",
    "network_name",
    "common_unique",
    "base_compare",
    "flag",
    "npi_count",
]
INDICATOR_COLUMNS = [
    "req_id",
    "network_id",
    "network_name",
    "Quality Score",
    "Cost Score",
    "Utilization Score",
    "New Flag",
    "Scoring Category",
]
