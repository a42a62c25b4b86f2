"""Small tables for tests."""

from __future__ import annotations

from rosterlens import schemas
from rosterlens.sources import canonical
from rosterlens.sources.requests import Requests


def request(
    req_id="Req",
    base=("1", "Org A", "100001"),
    compares=(("2", "Org B", "100002"),),
    counties="4013, 6037",
    client="8",
    **replaced,
) -> dict:
    def members(networks):
        entries = (
            f'"{i}":{{"parentOrganization":"{name}","planBidIds":"H0000","networkIds":"{raw}"}}'
            for i, name, raw in networks
        )
        return "{" + ",".join(entries) + "}"

    row = {
        "county": counties,
        "id": req_id,
        "filespath": "SAMPLE",
        "clientID": client,
        "userID": "user",
        "base": members([base]),
        "compare": members(compares),
        "baseParentOrg": base[1],
        "compareParentOrg": "|".join(c[1] for c in compares),
        "baseParentOrgId": base[0],
        "compareParentOrgId": ",".join(c[0] for c in compares),
        "planType": "HMO/HMO-POS",
        "planTypeId": "2",
    }
    return {**row, **replaced}


def requests(spark, *rows, **options) -> Requests:
    names = schemas.REQUEST.fieldNames()
    table = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schemas.REQUEST)
    return Requests(table, **options)


def _frame(spark, schema, rows, defaults):
    names = schema.fieldNames()
    full = [{**defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], schema)


def raw_individuals(spark, *rows):
    defaults = dict(
        raw_network_id=100001,
        npi=1,
        type="Individual",
        provider_type="Physician Specialists",
        state="AZ",
        fips=4013,
        county_name="Maricopa",
        specialty="Cardiology",
        location_confidence="High",
        address="1 Main St",
    )
    return _frame(spark, schemas.INDIVIDUALS, rows, defaults)


def individuals(spark, *rows):
    return canonical.clean_individuals(raw_individuals(spark, *rows))


def raw_organizations(spark, *rows):
    defaults = dict(
        raw_network_id=100001,
        npi=1,
        type="Organization",
        presentation_name="hospital 1",
        provider_type="Hospital",
        state="AZ",
        fips=4013,
        county_name="Maricopa",
        specialty="Hospital",
        specialty_code="80001",
        address="1 Hospital Ave",
        status="ACTIVE",
    )
    return _frame(spark, schemas.ORGANIZATIONS, rows, defaults).drop("address_key")


def organizations(spark, *rows):
    return canonical.clean_organizations(raw_organizations(spark, *rows))


def individual_scores(spark, *rows):
    names = "npi provider_type fips specialty quality cost ma_util ffs_util npi_score colour".split()
    defaults = dict(npi=1, provider_type="Physician Specialists", fips=4013, specialty="Cardiology")
    full = [{**defaults, **row} for row in rows]
    schema = (
        "npi long, provider_type string, fips long, specialty string, quality string, "
        "cost string, ma_util string, ffs_util string, npi_score string, colour string"
    )
    table = spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], schema)
    return canonical.individual_scores(table)


def organization_scores(spark, *rows):
    names = "npi address state fips quality cost ma_util ffs_util".split()
    defaults = dict(npi=1, address="1 Hospital Ave", state="AZ", fips=4013)
    full = [{**defaults, **row} for row in rows]
    schema = (
        "npi long, address string, state string, fips long, quality string, cost string, "
        "ma_util string, ffs_util string"
    )
    table = spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], schema)
    return canonical.organization_scores(table)


def hospital_names(spark, *rows):
    return canonical.hospital_names(spark.createDataFrame(list(rows), "name string, facility string"))


def market(spark, *rows):
    schema = "fips long, provider_type string, band string, quality long, cost long, utilization long"
    return spark.createDataFrame(list(rows), schema)
