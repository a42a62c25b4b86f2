"""Several data releases in one job, and folders found by a join."""

from __future__ import annotations

import shutil

import build
from conftest import individual_frame
from pyspark.sql import functions as F

from rosterlens.operators import sinks
from rosterlens.plans.comparison import compare_networks
from rosterlens.plans.releases import NO_FILES, compare_releases, read_releases, run_releases
from rosterlens.sources import clean, files, sample


def rows(tables):
    return {name: {tuple(r) for r in table.collect()} for name, table in tables.items()}


def two_releases(golden_dir, tmp_path):
    """The golden release, and one whose base network has lost all but its first providers."""
    root = tmp_path / "data"
    shutil.copytree(golden_dir, root / "May")
    shutil.copytree(golden_dir, root / "June")
    people = individual_frame()
    for code, part in people[people["raw_network_id"] == "100001"].groupby("specialty_code"):
        path = root / "June" / "network_files" / "Individual" / "100001" / f"{code}.parquet"
        part.drop(columns="raw_network_id").head(2).to_parquet(path, index=False)
    return str(root)


def test_each_request_is_answered_from_its_release(spark, golden_dir, tmp_path):
    root = two_releases(golden_dir, tmp_path)
    given = [build.request("M", filespath="May"), build.request("J", filespath=" June "), build.request("L", filespath="Lost")]
    requests = build.requests(spark, *given, build.request("up", filespath="../May"), build.request("no", filespath="May", client=""))
    out = str(tmp_path / "out")
    done = run_releases(requests, root, out, "first")
    reasons = {r["req_id"]: r["reason"] for r in done.rejected.collect()}
    assert reasons == {"L": NO_FILES, "up": "data release is not a folder name", "no": "client is not a number"}
    alone = {}
    for request, release in ((given[0], "May"), (given[1], "June")):
        one = build.requests(spark, request)
        alone[request["id"]] = rows(compare_networks(files.read_inputs(spark, f"{root}/{release}"), one))
    for name in alone["M"]:
        written = {tuple(r) for r in sinks.read_current(spark, out, name).collect()}
        assert written == alone["M"][name] | alone["J"][name], name
    assert {r[1:] for r in alone["M"]["provider_counts"]} != {r[1:] for r in alone["J"]["provider_counts"]}
    status = {r["req_id"]: r["reason"] for r in sinks.read_status(spark, out).collect()}
    assert status == {**reasons, "M": None, "J": None}


def test_a_table_of_releases_gives_their_roots(spark, golden_dir, tmp_path):
    table = [("May", golden_dir), ("twice", golden_dir), ("twice", str(tmp_path)), ("unused", "/nowhere")]
    requests = build.requests(
        spark,
        build.request("M", filespath="May"),
        build.request("T", filespath="twice"),
        build.request("N", filespath="none"),
        releases=spark.createDataFrame(table, "release string, root string"),
    )
    assert {r["req_id"]: r["reason"] for r in requests.rejected.collect()} == {
        "T": "data release is unknown",
        "N": "data release is unknown",
    }
    parts, _ = read_releases(requests, "/not used")
    found = rows({"c": compare_releases(parts)["provider_counts"]})
    alone = build.requests(spark, build.request("M"))
    assert found == rows({"c": compare_networks(files.read_inputs(spark, golden_dir), alone)["provider_counts"]})


def test_no_request_is_left(spark, tmp_path):
    requests = build.requests(spark, build.request("L", filespath="Lost"))
    parts, requests = read_releases(requests, str(tmp_path / "none"))
    assert parts == [] and compare_releases(parts) == {} and requests.rejected.count() == 1


def test_folders_of_the_clean_layer_are_found_by_the_join(spark, tmp_path):
    """Many networks, of which a request reads two; nothing is collected for it."""
    people = sample.sample_inputs(spark)
    ids = [r[0] for r in people.individuals.select("raw_network_id").distinct().collect()]
    more = people.individuals.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(19))))
    more = more.withColumn("raw_network_id", F.col("raw_network_id") + 1000 * F.col("k")).drop("k")
    layer = str(tmp_path / "clean")
    clean.write_clean(files.Inputs(**{**people.__dict__, "individuals": more}), layer)
    counties = ", ".join(str(c[0]) for c in sample.COUNTIES)
    requests = build.requests(spark, build.request(counties=counties))
    read = clean.read_clean(spark, layer, requests=requests)
    rows_read = requests.restrict(read.individuals)
    execution = rows_read._jdf.queryExecution()
    execution.toRdd().count()
    plan = execution.executedPlan().toString()
    assert "dynamicpruning" in plan and "Exchange hashpartitioning" not in plan
    folders = spark.read.parquet(f"{layer}/individuals").select("raw_network_id").distinct().count()
    assert folders == 20 * len(ids)
    assert {r[0] for r in rows_read.select("raw_network_id").distinct().collect()} <= set(ids)
    expected = rows(compare_networks(people, requests))
    assert rows(compare_networks(read, requests)) == expected


def test_files_are_chosen_by_the_requests(spark, golden_dir):
    requests = build.requests(spark, build.request(counties="4013"))
    inputs = files.read_inputs(spark, golden_dir, requests=requests)
    assert {r["fips"] for r in inputs.individuals.collect()} == {4013}
    assert {r["fips"] for r in inputs.individual_scores.collect()} == {4013}
    lists = files.read_inputs(spark, golden_dir, [100001, 100002], [4013])
    assert rows(compare_networks(inputs, requests)) == rows(compare_networks(lists, requests))
