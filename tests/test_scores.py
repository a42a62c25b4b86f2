from __future__ import annotations

import random
from collections import defaultdict

import build

from rosterlens.operators import indicators, scoring


def test_best_score_row_per_key(spark):
    scores = build.individual_scores(
        spark,
        dict(quality="3", cost="n/a", ma_util="10", colour="Red"),
        dict(quality="3", cost="2", ma_util="5", colour="Green"),
        dict(quality="NaN", cost="5", ma_util="99"),
        dict(npi=2, quality="", cost="x"),
        dict(npi=None, quality="5"),
    )
    rows = {r["npi"]: r for r in scores.collect()}
    assert set(rows) == {1, 2}
    assert (rows[1]["quality"], rows[1]["cost"], rows[1]["ma_util"]) == (3.0, 2.0, 5.0)
    assert rows[1]["colour"] == "Green"
    assert rows[2]["quality"] is None and rows[2]["cost"] is None


def test_pcp_scores_match_whatever_their_specialty(spark):
    scores = build.individual_scores(
        spark,
        dict(provider_type="PCP", specialty="Family Medicine", quality="2"),
        dict(provider_type="PCP", specialty="PCP", quality="4"),
        dict(provider_type="Physician Specialists", specialty="Dermatology", quality="1"),
    )
    people = build.individuals(
        spark,
        dict(provider_type="PCP", specialty="Internal Medicine"),
        dict(provider_type="Physician Specialists", specialty="Cardiology"),
        dict(provider_type="Physician Specialists", specialty="Dermatology"),
    )
    found = {
        (r["provider_type"], r["specialty"]): r["quality"]
        for r in scoring.score_individuals(people, scores).collect()
    }
    assert found == {
        ("PCP", "Internal Medicine"): 4.0,
        ("Physician Specialists", "Cardiology"): None,
        ("Physician Specialists", "Dermatology"): 1.0,
    }


def test_organization_scores_match_by_normalised_address(spark):
    scores = build.organization_scores(spark, dict(address=" 1 hospital AVE", quality="4"))
    places = build.organizations(
        spark, dict(address="1 Hospital Ave "), dict(npi=1, state="CA"), dict(address="2 Other St")
    )
    found = sorted(
        (r["state"], r["address"], r["quality"])
        for r in scoring.score_organizations(places, scores).collect()
    )
    assert found == [
        ("AZ", "1 Hospital Ave ", 4.0),
        ("AZ", "2 Other St", None),
        ("CA", "1 Hospital Ave", None),
    ]


def band(value, low, high, inclusive_low=True):
    if value is None:
        return None
    return "High" if value >= high else "Low" if value <= low else "Medium"


def test_indicators_by_brute_force(spark):
    rng = random.Random(1)
    rows = [
        dict(
            raw_network_id=rng.choice([1, 2, 3]),
            npi=rng.randrange(12),
            state="AZ",
            fips=rng.choice([4013, 6037]),
            provider_type=rng.choice(["PCP", "Other Providers"]),
            specialty=rng.choice(["A", "B"]),
            location_confidence=rng.choice(["Low", "High"]),
            address=str(rng.random()),
        )
        for _ in range(200)
    ]
    choices = ["1", "2", "2.01", "3.99", "4", "5", "n/a", None]
    scores = [
        dict(
            npi=npi,
            provider_type=kind,
            fips=fips,
            specialty=specialty,
            quality=rng.choice(choices),
            cost=rng.choice(choices),
            ma_util=rng.choice(["0", "40", "40.5", "79.9", "80", "", None]),
        )
        for npi in range(9)
        for kind in ("PCP", "Other Providers")
        for fips in (4013, 6037)
        for specialty in (("PCP",) if kind == "PCP" else ("A", "B"))
    ]
    requests = build.requests(
        spark,
        build.request("R", ("1", "A", "1,3"), (("2", "B", "2"), ("3", "C", "3")), "4013"),
        build.request("S", ("2", "B", "2"), (("1", "A", "1"),), "4013,6037"),
    )
    members = {
        "R": {"1_2": {1, 3}, "2_2": {2}, "3_2": {3}},
        "S": {"2_2": {2}, "1_2": {1}},
    }
    counties = {"R": {4013}, "S": {4013, 6037}}

    def number(text):
        try:
            return float(text)
        except (TypeError, ValueError):
            return None

    by_key = {(s["npi"], s["provider_type"], s["fips"], s["specialty"]): s for s in scores}
    expected = defaultdict(int)
    for req, networks in members.items():
        for net, raws in networks.items():
            distinct = {
                (r["npi"], r["fips"], r["provider_type"], r["specialty"], r["location_confidence"])
                for r in rows
                if r["raw_network_id"] in raws and r["fips"] in counties[req]
            }
            for npi, fips, kind, specialty, _ in distinct:
                for b in ("High", "Medium", "Low"):
                    for measure in range(3):
                        expected[(req, net, kind, b, measure)] += 0
                score = by_key.get((npi, kind, fips, "PCP" if kind == "PCP" else specialty))
                if score is None:
                    continue
                bands = (
                    band(number(score["quality"]), 2, 4),
                    band(number(score["cost"]), 2, 4),
                    band(number(score["ma_util"]), 40, 80),
                )
                for measure, b in enumerate(bands):
                    if b is not None:
                        expected[(req, net, kind, b, measure)] += 1
    found = indicators.individual_bands(
        build.individuals(spark, *rows), build.individual_scores(spark, *scores), requests
    ).collect()
    result = {
        (r["req_id"], r["network_id"], r["provider_type"], r["band"], measure): r[name]
        for r in found
        for measure, name in enumerate(indicators.MEASURES)
    }
    assert result == dict(expected)


def test_only_hospitals_are_banded_and_more_listings_count_once(spark):
    requests = build.requests(spark, build.request(counties="4013"))
    places = build.organizations(
        spark,
        dict(npi=1),
        dict(npi=1, presentation_name="another name"),
        dict(npi=1, address=" 1 HOSPITAL ave"),
        dict(npi=2, provider_type="Clinic"),
        dict(npi=3, raw_network_id=100002),
    )
    scores = build.organization_scores(spark, dict(quality="4"), dict(npi=2, quality="4"))
    rows = indicators.hospital_bands(places, scores, requests).collect()
    found = {(r["network_id"], r["provider_type"], r["band"]): r["quality"] for r in rows}
    assert found == {
        ("1_2", "Hospital", "High"): 1,
        ("1_2", "Hospital", "Medium"): 0,
        ("1_2", "Hospital", "Low"): 0,
        # A network without any score still has its three rows.
        ("2_2", "Hospital", "High"): 0,
        ("2_2", "Hospital", "Medium"): 0,
        ("2_2", "Hospital", "Low"): 0,
    }


def test_market_benchmark(spark):
    requests = build.requests(spark, build.request(counties="4013"))
    market = build.market(
        spark,
        (4013, "PCP", "High", 1, 2, 3),
        (4013, "PCP", "High", 10, 20, None),
        (4013, "PCP", "Not Available", 5, 5, 5),
        (6037, "PCP", "High", 7, 7, 7),
    )
    rows = indicators.market_benchmark(market, requests).collect()
    assert [(r["quality"], r["cost"], r["utilization"]) for r in rows] == [(11, 22, 3)]
    assert rows[0]["network_id"] == "" and rows[0]["network_name"] == "Common Counties"
