from __future__ import annotations

import build
import pytest

from rosterlens.operators import exports


@pytest.fixture(scope="module")
def requests(spark):
    return build.requests(
        spark,
        build.request("R8", counties="4013,6037", client="8"),
        build.request("R45", counties="4013", client="45"),
        build.request("R1", counties="4013", client="1"),
    )


def individual_rows(spark, requests, people, scores=(), places=(), place_scores=(), names=()):
    hospitals = exports.hospital_rows(
        build.organizations(spark, *places),
        build.organization_scores(spark, *place_scores),
        build.hospital_names(spark, *names),
        requests,
    )
    export = exports.individual_export(
        build.individuals(spark, *people),
        build.individual_scores(spark, *scores),
        hospitals,
        requests,
    )
    return [r.asDict() for r in export.collect()]


def test_text_columns(spark, requests):
    person = dict(
        npi=1,
        first_name="o'neil-smith",
        last_name=None,
        presentation_name="DR 3RD o'neil",
        address="12b main st",
        zip_code="01234",
        city="los angeles",
        county_name="LOS ANGELES",
        location_confidence="LOCATION CONFIDENCE NOT AVAILABLE",
        group_tin="700000.0",
        group_name="  ",
        specialty_flag=None,
    )
    row = next(r for r in individual_rows(spark, requests, [person]) if r["req_id"] == "R8")
    assert row["First Name"] == "O'Neil-Smith" and row["Last Name"] == "NA"
    assert row["Presentation Name"] == "Dr 3Rd O'Neil"
    assert row["Address First Line"] == "12B Main St" and row["Zip Code"] == "01234"
    assert row["City"] == "Los Angeles" and row["County"] == "Los Angeles"
    assert row["Location Confidence County Level"] == "Location Confidence Not Available"
    assert row["Location Confidence Address level"] == "NA"
    assert row["Group TIN"] == "700000" and row["Group Name"] == "NA"
    assert row["Specialty Flag"] == "Not Applicable"
    assert row["Quality Score"] == "NA" and row["NPI Score Confidence"] == "NA"
    assert row["is_scored"] is False


def test_clients_see_their_columns_and_no_duplicates(spark, requests):
    people = [dict(npi=1, address="1 A St"), dict(npi=1, address="2 B St")]
    rows = individual_rows(spark, requests, people)
    by_request = {q: [r for r in rows if r["req_id"] == q] for q in ("R8", "R45", "R1")}
    assert len(by_request["R8"]) == 2
    assert len(by_request["R45"]) == 1 and by_request["R45"][0]["Address First Line"] is None
    assert len(by_request["R1"]) == 1 and by_request["R1"][0]["Specialty Flag"] is None


def test_flags_use_the_county_name(spark, requests):
    people = [
        # Listed by the other network under another code of the same county name.
        dict(npi=1, fips=4013, county_name="Maricopa"),
        dict(npi=1, fips=6037, county_name="Maricopa", raw_network_id=100002),
        # Another county name: not the same provider place.
        dict(npi=2, fips=4013, county_name="Maricopa"),
        dict(npi=2, fips=6037, county_name="Los Angeles", raw_network_id=100002),
        # Missing county names agree with each other.
        dict(npi=3, county_name=None),
        dict(npi=3, county_name=None, raw_network_id=100002),
    ]
    rows = individual_rows(spark, requests, people)
    flags = {
        (r["req_id"], r["NPI"], r["FIPS State County Code"]): (
            r["In Base Network"],
            r["In Compare Network"],
        )
        for r in rows
    }
    assert flags[("R8", 1, 4013)] == flags[("R8", 1, 6037)] == ("Y", "Y")
    # The second county is not requested here, so its listing does not count.
    assert flags[("R45", 1, 4013)] == ("Y", "N") and ("R45", 1, 6037) not in flags
    assert flags[("R8", 2, 4013)] == ("Y", "N") and flags[("R8", 2, 6037)] == ("N", "Y")
    assert flags[("R8", 3, 4013)] == ("Y", "Y")


def test_provider_without_specialty_is_listed_without_score(spark, requests):
    rows = individual_rows(
        spark, requests, [dict(npi=1, specialty=None)], scores=[dict(npi=1, quality="4")]
    )
    assert {r["Quality Score"] for r in rows if r["req_id"] == "R8"} == {"NA"}


def test_hospital_rows(spark, requests):
    places = [
        dict(npi=1, presentation_name=" mercy HOSPITAL "),
        dict(npi=2, presentation_name="st.mary's", address=" 9 old rd "),
        dict(npi=3, provider_type="Clinic"),
    ]
    rows = individual_rows(
        spark,
        requests,
        [],
        places=places,
        place_scores=[dict(npi=1, quality="4.5", cost="3")],
        names=[("Mercy Hospital", " Mercy Medical Center ")],
    )
    found = {r["NPI"]: r for r in rows if r["req_id"] == "R8"}
    assert set(found) == {1, 2}
    assert found[1]["Presentation Name"] == "Mercy Medical Center"
    assert found[1]["Quality Score"] == "4.5" and found[1]["NPI Score"] == "NA"
    assert found[1]["Location Confidence County Level"] == "High"
    assert found[1]["First Name"] == "NA" and found[1]["Specialty Flag"] == "Not Applicable"
    assert found[2]["Presentation Name"] == "St.Mary'S"
    assert found[2]["Address First Line"] == "9 Old Rd"


def test_organization_export_keeps_the_address_for_every_client(spark, requests):
    hospitals = exports.hospital_rows(
        build.organizations(spark, dict(npi=1, address="1 hospital ave")),
        build.organization_scores(spark, dict(npi=1, quality="4", ma_util="55")),
        build.hospital_names(spark),
        requests,
    )
    export = exports.organization_export(hospitals, requests)
    rows = {r["req_id"]: r.asDict() for r in export.collect()}
    assert {r["Address First Line"] for r in rows.values()} == {"1 Hospital Ave"}
    assert rows["R45"]["MA Utilization Score"] == "55.0"
    assert rows["R1"]["MA Utilization Score"] is None
    assert "MA Utilization Score" not in exports.organization_columns(1)


def test_view_names_its_flags_after_the_plans(spark, requests):
    hospitals = exports.hospital_rows(
        build.organizations(spark, dict(npi=1)),
        build.organization_scores(spark),
        build.hospital_names(spark),
        requests,
    )
    export = exports.organization_export(hospitals, requests)
    columns = exports.organization_columns(8)
    named = exports.export_view(export, columns, "Org A HMO", "Org B HMO").columns
    assert "Org A HMO" in named and "Org B HMO" in named
    same = exports.export_view(export, columns, "Org A HMO", "Org A HMO").columns
    assert len(same) == len(set(same))


def test_keys_are_compared_by_their_telling_columns_and_origins_by_networks_and_places(spark):
    from pyspark.sql import functions as F
    from rosterlens.operators import exports

    key = ["npi", "state", "county_name", "address_key", "provider_type", "specialty_code"]
    assert exports._telling(key) == ["npi", "specialty_code", "provider_type", "address_key", "county_name", "state"]
    places = "array(named_struct('raw_network_id', 1L, 'place_fips', 5L), named_struct('raw_network_id', 2L, 'place_fips', 7L))"
    none = "cast(null as array<struct<raw_network_id: bigint, place_fips: bigint>>)"
    rows = spark.createDataFrame([([1], 0), ([1, 2], 0), ([1, 2], 0), ([12], 0), ([1, 2], 1)], "networks array<long>, several int")
    rows = rows.withColumn("places", F.when(F.col("several") == 1, F.expr(places)).otherwise(F.expr(none)))
    origins = [r["origin"] for r in exports._with_origin(rows).collect()]
    assert origins[1] == origins[2] and len(set(origins)) == 4
