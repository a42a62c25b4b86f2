from __future__ import annotations

import build


def reasons(requests):
    return {r["req_id"]: r["reason"] for r in requests.rejected.collect()}


def test_pairs_members_sides_and_counties(spark):
    requests = build.requests(
        spark,
        build.request(
            base=("1", "Org A", "100001, 100003"),
            compares=(("2", "Org B", "100002"), ("3", " Org C ", "100003,7")),
        ),
    )
    pairs = {r["pair_idx"]: r for r in requests.pairs.collect()}
    assert pairs[1]["base_id"] == "1_2" and pairs[1]["compare_id"] == "2_2"
    assert pairs[2]["compare_name"] == "Org C HMO/HMO-POS"
    assert pairs[2]["base_raw"] == [100001, 100003] and pairs[2]["compare_raw"] == [100003, 7]
    members = {(r["network_id"], r["raw_network_id"]) for r in requests.members.collect()}
    assert members == {("1_2", 100001), ("1_2", 100003), ("2_2", 100002), ("3_2", 100003), ("3_2", 7)}
    sides = {
        (r["pair_idx"], r["raw_network_id"]): (r["in_base"], r["in_compare"])
        for r in requests.sides.collect()
    }
    assert sides[(2, 100003)] == (True, True)
    assert sides[(1, 100002)] == (False, True)
    assert {r["fips"] for r in requests.counties.collect()} == {4013, 6037}
    assert requests.raw_network_ids() == [7, 100001, 100002, 100003]
    assert requests.county_codes() == [4013, 6037]


def test_rejected_requests(spark):
    requests = build.requests(
        spark,
        build.request("good"),
        build.request("county", counties="4013,x"),
        build.request("names", compareParentOrg="Org B|Org C"),
        build.request("blank", compareParentOrgId=""),
        build.request("unknown", compareParentOrgId="9"),
        {**build.request("json"), "base": "{"},
        build.request("members", compares=(("2", "Org B", "100002,x"),)),
        build.request("twice", client="8"),
        build.request("twice", client="45"),
    )
    assert reasons(requests) == {
        "county": "county is not a number",
        "names": "compare ids and names differ in length",
        "blank": "compare id is blank",
        "unknown": "network has no usable member ids",
        "json": "networks are not JSON",
        "members": "network has no usable member ids",
        "twice": "request id is used twice",
    }
    assert {r["req_id"] for r in requests.pairs.collect()} == {"good"}


def test_the_same_request_twice_counts_once(spark):
    requests = build.requests(spark, build.request(), build.request())
    assert requests.pairs.count() == 1 and requests.rejected.count() == 0


def test_one_network_on_both_sides(spark):
    requests = build.requests(
        spark, build.request(base=("1", "Org A", "5"), compares=(("1", "Org A again", "6"),))
    )
    # Each side has its own members; under one id the network has all of them.
    pair = requests.pairs.first()
    assert pair["base_id"] == pair["compare_id"] == "1_2"
    assert pair["base_name"] == pair["compare_name"] == "Org A HMO/HMO-POS"
    assert sorted(pair["base_raw"]) == [5, 6]


def test_large_request_tables_are_not_broadcast(spark):
    small = build.requests(spark, build.request())
    large = build.requests(spark, build.request(), broadcast_rows=1)

    def hinted(requests):
        plan = requests.small(requests.sides)._jdf.queryExecution().analyzed().toString()
        return "ResolvedHint (strategy=broadcast)" in plan

    assert hinted(small) and not hinted(large)


def test_bad_values_are_rejected_one_by_one(spark):
    bad = {
        "fraction": dict(base=("1", "Org A", "100001.6")),
        "county": dict(counties="6037.5"),
        "client": dict(client="abc"),
        "wide": dict(client="99999999999"),
        "plan": dict(planTypeId=None),
    }
    table = build.requests(spark, build.request("good"), *(build.request(k, **v) for k, v in bad.items()))
    assert [r["req_id"] for r in table.accepted.collect()] == ["good"]
    reasons = {r["req_id"]: r["reason"] for r in table.rejected.collect()}
    assert reasons == {
        "fraction": "network has no usable member ids",
        "county": "county is not a number",
        "client": "client is not a number",
        "wide": "client is not a number",
        "plan": "plan type is missing",
    }


def test_letters_after_digits_are_no_number(spark):
    from pyspark.sql import functions as F

    from rosterlens.functions.scores import number

    rows = spark.createDataFrame([("4d",), ("4f",), ("4.5",), ("1e2",)], "t string").select(number(F.col("t")))
    assert [r[0] for r in rows.collect()] == [None, None, 4.5, 100.0]


def test_of_request_asks_for_its_own_networks_and_counties_only(spark):
    requests = build.requests(
        spark,
        build.request("R1", base=("1", "Org A", "100001"), compares=(("2", "Org B", "100002"),)),
        build.request("R2", base=("3", "Org C", "100003"), compares=(("2", "Org B", "100002"),)),
    )
    one = requests.of_request("R2")
    assert {r["req_id"] for r in one.pairs.collect()} == {"R2"}
    assert one.raw_network_ids() == [100002, 100003]
    assert requests.of_request("R3").pairs.count() == 0
