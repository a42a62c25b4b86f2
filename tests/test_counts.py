"""Counts and flags against the definitions, computed in plain Python on small tables."""

from __future__ import annotations

import random
from collections import defaultdict

import build
import pytest
from pyspark.sql import functions as F

from rosterlens.operators import counts, membership
from rosterlens.sources import canonical


def table(df):
    return sorted(
        (r["req_id"], r["network_id"], r["base_compare"], r["flag"], r["common_unique"], r["npi_count"])
        for r in df.collect()
    )


# id, members
NETWORKS = {"1": {1, 3}, "2": {2}, "3": {3, 4}, "4": {4}}


def network(org):
    return (org, f"Org {org}", ",".join(str(i) for i in sorted(NETWORKS[org])))


def three_requests(spark, **options):
    return build.requests(
        spark,
        build.request("A", network("1"), (network("2"), network("3")), "4013,6037"),
        build.request("B", network("3"), (network("1"),), "4013"),
        build.request("C", network("2"), (network("2"), network("4")), "4013,6037,17"),
        **options,
    )


PAIRS = [
    ("A", 1, "1", "2", {4013, 6037}),
    ("A", 2, "1", "3", {4013, 6037}),
    ("B", 1, "3", "1", {4013}),
    ("C", 1, "2", "2", {4013, 6037, 17}),
    ("C", 2, "2", "4", {4013, 6037, 17}),
]


def random_rows(seed, n=300):
    rng = random.Random(seed)
    return [
        dict(
            raw_network_id=rng.choice([1, 2, 3, 4, 5]),
            npi=rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, None]),
            state=rng.choice(["AZ", "CA"]),
            fips=rng.choice([4013, 6037, 17, 99, None]),
            county_name=rng.choice(["Maricopa", "Los Angeles", None]),
            provider_type=rng.choice(["PCP", "Physician Specialists", "Other Providers", "None"]),
            specialty=rng.choice(["Cardiology", "cardiology", "Dermatology", "Other", None]),
        )
        for _ in range(n)
    ]


def kept(rows):
    return [
        r
        for r in rows
        if r["npi"] is not None and r["fips"] is not None and r["provider_type"] != "None"
    ]


def brute_force_counts(rows, key, flag, counted):
    """Pair by pair: put both networks together, flag keys in two networks, count, add up."""
    out = []
    for req, idx, base, compare, counties in PAIRS:
        both = []
        for org in dict.fromkeys([base, compare]):
            both += [(org, r) for r in rows if r["raw_network_id"] in NETWORKS[org] and r["fips"] in counties]
        holders = defaultdict(set)
        for org, r in both:
            holders[tuple(r[c] for c in key)].add(org)
        groups = defaultdict(set)
        for org, r in both:
            kind = "common" if len(holders[tuple(r[c] for c in key)]) > 1 else "unique"
            groups[(org, r[flag], kind, r["state"], r["fips"])].add(tuple(r[c] for c in counted))
        totals = defaultdict(int)
        for (org, value, kind, _, _), providers in groups.items():
            totals[(org, value, kind)] += len(providers)
        for (org, value, kind), n in totals.items():
            label = ("base_" if org == base else "") + f"Compare_{idx}"
            out.append((req, f"{org}_2", label, value, kind, n))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_individual_counts(spark, seed, broadcast_rows):
    rows = random_rows(seed)
    found = counts.individual_counts(
        build.individuals(spark, *rows), three_requests(spark, broadcast_rows=broadcast_rows)
    )
    assert table(found) == brute_force_counts(
        kept(rows), canonical.INDIVIDUAL_KEY, "provider_type", ["npi"]
    )


@pytest.mark.parametrize("seed", [3, 4])
def test_specialty_counts(spark, seed):
    rows = random_rows(seed)
    listed = canonical.specialty_list(
        spark.createDataFrame([(" Cardiology",), ("DERMATOLOGY",), ("Unused's",)], "s string")
    )
    found = counts.specialty_counts(build.individuals(spark, *rows), listed, three_requests(spark))
    subset = [r for r in kept(rows) if (r["specialty"] or "").upper() in ("CARDIOLOGY", "DERMATOLOGY")]
    assert table(found) == brute_force_counts(
        subset, canonical.INDIVIDUAL_KEY, "specialty", ["npi"]
    )


@pytest.mark.parametrize("seed", [5, 6])
def test_organization_counts(spark, seed):
    rng = random.Random(seed)
    rows = [
        {
            **r,
            "provider_type": rng.choice(["Hospital", "Clinic", "None", None]),
            "address": rng.choice(["1 Main St", " 1 MAIN st ", "2 Main St", None]),
            "specialty_code": rng.choice(["a", "b", None]),
            "status": rng.choice(["ACTIVE", "active", "Inactive", None]),
        }
        for r in random_rows(seed, 600)
    ]
    found = counts.organization_counts(build.organizations(spark, *rows), three_requests(spark))
    usable = [
        {**r, "address_key": r["address"].strip().upper()}
        for r in rows
        if (r["status"] or "").upper() == "ACTIVE"
        and r["provider_type"] not in ("None", None)
        and r["address"] is not None
        and r["specialty_code"] is not None
        and r["npi"] is not None
        and r["fips"] is not None
    ]
    assert usable
    assert table(found) == brute_force_counts(
        usable,
        canonical.ORGANIZATION_KEY,
        "provider_type",
        ["npi", "address_key", "specialty_code"],
    )


def brute_force_flags(rows, key):
    out = set()
    for req, idx, base, compare, counties in PAIRS:
        inside = [r for r in rows if r["fips"] in counties]
        in_base = {tuple(r[c] for c in key) for r in inside if r["raw_network_id"] in NETWORKS[base]}
        in_compare = {
            tuple(r[c] for c in key) for r in inside if r["raw_network_id"] in NETWORKS[compare]
        }
        for k in in_base | in_compare:
            out.add((req, idx, *k, "Y" if k in in_base else "N", "Y" if k in in_compare else "N"))
    return out


def test_membership_flags_by_county_name(spark):
    rows = random_rows(7)
    key = membership.COUNTY_NAME_KEY
    requests = three_requests(spark)
    people = build.individuals(spark, *rows)
    found = {tuple(r) for r in membership.membership_flags(people, key, requests).collect()}
    assert found == brute_force_flags(kept(rows), key)


def test_outer_join_and_semi_anti_joins_agree(spark):
    rows = random_rows(8)
    key = canonical.INDIVIDUAL_KEY
    requests = three_requests(spark)
    people = build.individuals(spark, *rows)
    flags = {tuple(r) for r in membership.membership_flags(people, key, requests).collect()}
    outer = membership.membership_by_outer_join(people, key, requests)
    assert {tuple(r) for r in outer.collect()} == flags
    split = {tuple(r) for r in membership.common_and_unique(people, key, requests).collect()}
    expected = set()
    for *k, in_base, in_compare in flags:
        if in_base == "Y":
            one_network = (k[0], k[1]) == ("C", 1)
            common = in_compare == "Y" and not one_network
            expected.add((*k, "common" if common else "unique"))
    assert split == expected


def test_results_do_not_depend_on_duplicates_or_partitions(spark):
    rows = random_rows(9)
    requests = three_requests(spark)
    once = build.individuals(spark, *rows)
    often = build.individuals(spark, *(rows * 3)).repartition(13, "specialty")
    assert table(counts.individual_counts(often, requests)) == table(
        counts.individual_counts(once, requests)
    )


def test_many_requests_equal_single_requests(spark):
    rows = random_rows(10)
    people = build.individuals(spark, *rows)
    together = table(counts.individual_counts(people, three_requests(spark)))
    alone = []
    for request in (
        build.request("A", network("1"), (network("2"), network("3")), "4013,6037"),
        build.request("B", network("3"), (network("1"),), "4013"),
        build.request("C", network("2"), (network("2"), network("4")), "4013,6037,17"),
    ):
        alone += table(counts.individual_counts(people, build.requests(spark, request)))
    assert together == sorted(alone)


def test_swapped_networks_have_the_same_common_counts(spark):
    people = build.individuals(spark, *random_rows(11))
    there = build.requests(spark, build.request("R", network("1"), (network("2"),), "4013"))
    back = build.requests(spark, build.request("R", network("2"), (network("1"),), "4013"))

    def common(requests):
        rows = table(counts.individual_counts(people, requests))
        return sorted((n, flag, c) for _, n, _, flag, kind, c in rows if kind == "common")

    assert common(there) == common(back)


def test_suppressed_network(spark):
    requests = build.requests(
        spark,
        build.request("all", ("1", "A", "208546"), (("2", "B", "100002"),)),
        build.request("some", ("1", "A", "208546,5"), (("2", "B", "208546"),)),
    )
    rows = counts.suppressed_rows(requests).collect()
    assert {(r["req_id"], r["network_id"], r["base_compare"]) for r in rows} == {
        ("all", "1_2", "base_Compare_1"),
        ("some", "2_2", "Compare_1"),
    }
    assert all(r["flag"] == "Hospital" and r["npi_count"] is None for r in rows)
    assert all(r["common_unique"] is None for r in rows)


def test_blank_rows_for_pairings_without_providers(spark):
    requests = three_requests(spark)
    people = build.individuals(spark, dict(raw_network_id=2, npi=1, fips=17, state="IL"))
    found = counts.fill_blank_pairings(
        counts.individual_counts(people, requests), counts.individual_flags(), requests
    )
    blank = found.where("npi_count is null")
    by_pairing = {
        (r["req_id"], r["base_compare"]): r["n"]
        for r in blank.groupBy("req_id", "base_compare").agg(F.count("*").alias("n")).collect()
    }
    # Three provider types, common and unique, for both networks of the empty pairings.
    assert by_pairing == {
        ("A", "base_Compare_1"): 6,
        ("A", "Compare_1"): 6,
        ("A", "base_Compare_2"): 6,
        ("A", "Compare_2"): 6,
        ("B", "base_Compare_1"): 6,
        ("B", "Compare_1"): 6,
    }
    listed = canonical.specialty_list(spark.createDataFrame([("Cardiology",), ("Unused",)], "s string"))
    specialty = counts.specialty_counts(people, listed, requests)
    filled = counts.fill_blank_pairings(specialty, counts.specialty_flags(listed), requests)
    assert filled.where("npi_count is null").count() == 3 * 2 * 2 * 2
