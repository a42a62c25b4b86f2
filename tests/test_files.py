from __future__ import annotations

import re

import build
import pytest

from pyspark.sql.types import StringType, StructField, StructType
from rosterlens import schemas
from rosterlens.operators import sinks
from rosterlens.plans.comparison import compare_networks, run_comparison
from rosterlens.sources import canonical, clean, files, sample
from rosterlens.sources.codes import excluded_codes
from rosterlens.sources.status import source_status


def sets(tables):
    return {name: {tuple(r) for r in table.collect()} for name, table in tables.items()}


def test_excluded_codes():
    codes = excluded_codes()
    assert len(codes) == len(set(codes)) == 198
    assert "25270" in codes and "17060" in codes and "90001" not in codes


def test_excluded_files_are_not_read(spark, golden_dir):
    rows = files.scan_individuals(spark, golden_dir)
    assert {r["raw_network_id"]: r["count"] for r in rows.groupBy("raw_network_id").count().collect()} == {
        100001: 54,
        100002: 54,
    }
    assert files.scan_individuals(spark, golden_dir, [100002]).count() == 54


def test_county_filters_reach_the_files(spark, golden_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    inputs = files.read_inputs(spark, golden_dir, [100001], [4013])
    scan = inputs.individuals._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(`FIPS State County Code`,4013)" in scan
    scores = inputs.individual_scores._jdf.queryExecution().executedPlan().toString()
    assert scores.index("Aggregate") < scores.index("= 4013")
    assert {r["fips"] for r in inputs.individual_scores.collect()} == {4013}
    assert inputs.individuals.count() == 27


def test_excluded_files_and_other_networks_are_not_opened(spark, golden_dir):
    rows = files.scan_individuals(spark, golden_dir, [100002])
    execution = rows._jdf.queryExecution()
    execution.toRdd().count()
    scan = execution.executedPlan().collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 3


def test_zip_codes_and_codes_stay_text(spark, tmp_path):
    folder = tmp_path / "network_files" / "Organization"
    folder.mkdir(parents=True)
    header = ",".join(schemas.ORGANIZATION_FILE.fieldNames())
    cells = "1,Organization,hospital,,,7,n,Org A,c,s,s,00801,Hospital,Town,MA,01234,County,25001,1 A St,ACTIVE"
    (folder / "7.csv").write_text(f"{header}\n{cells}\n")
    row = files.scan_organizations(spark, str(tmp_path)).first()
    assert row["zip_code"] == "01234" and row["specialty_code"] == "00801"
    assert (row["raw_network_id"], row["npi"], row["fips"]) == (7, 1, 25001)
    assert row["specialty"] == "s" and row["parent_org"] == "Org A" and row["group_tin"] is None


def test_missing_sources_are_empty(spark, tmp_path):
    assert files.scan_individuals(spark, str(tmp_path)).count() == 0
    rows = files.scan_organizations(spark, str(tmp_path))
    assert rows.count() == 0 and "address_key" in rows.columns


def test_source_status(spark, golden_dir):
    requests = build.requests(
        spark, build.request(base=("1", "A", "100001"), compares=(("2", "B", "100002,100009"),))
    )
    status = source_status(
        requests,
        files.scan_individuals(spark, golden_dir),
        files.scan_organizations(spark, golden_dir),
    )
    found = {(r["source"], r["raw_network_id"]): (r["n_rows"], r["status"]) for r in status.collect()}
    assert found[("individual", 100001)] == (54, "read")
    assert found[("organization", 100002)] == (18, "read")
    assert found[("organization", 100009)] == (0, "missing")


def test_rows_without_key_are_counted(spark):
    requests = build.requests(spark, build.request())
    people = build.raw_individuals(
        spark, dict(npi=1), dict(npi=None), dict(npi=2, provider_type="None"), dict(fips=None)
    )
    places = build.raw_organizations(spark, dict(npi=1), dict(address=None), dict(provider_type=None))
    status = source_status(requests, people, places)
    found = {(r["source"], r["raw_network_id"]): r for r in status.collect()}
    person = found[("individual", 100001)]
    assert (person["n_rows"], person["n_reportable"], person["n_without_key"]) == (4, 3, 2)
    place = found[("organization", 100001)]
    assert (place["n_rows"], place["n_reportable"], place["n_without_key"]) == (3, 2, 1)


def test_scan_of_bad_score_cells(spark, tmp_path):
    (tmp_path / "Scores for Organization - X.csv").write_text(
        "extra,npi,Address First Line,state,FIPS State County Code,Quality Score,Cost Score,"
        "FFS Utilization Score,MA Utilization Score\n"
        "x,1,1 Main St,AZ,4013,4.5,n/a,,NaN\n"
        "x,2,short row\n"
        "x,none,1 Main St,AZ,4013,4,4,4,4\n"
    )
    rows = files.organization_scores(spark, str(tmp_path)).collect()
    assert len(rows) == 1
    assert rows[0]["npi"] == 1 and rows[0]["quality"] == 4.5
    assert rows[0]["cost"] is None and rows[0]["ma_util"] is None


def test_clean_layer_gives_the_same_results(spark, golden_dir, tmp_path):
    requests = build.requests(spark, build.request())
    inputs = files.read_inputs(spark, golden_dir)
    clean.write_clean(inputs, str(tmp_path / "clean"))
    cleaned = clean.read_clean(
        spark, str(tmp_path / "clean"), requests.raw_network_ids(), requests.county_codes()
    )
    scan = cleaned.individuals._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*raw_network_id#\d+ IN \(100001,100002\)", scan)
    assert "In(fips, [4013,6037])" in scan
    assert sets(compare_networks(cleaned, requests)) == sets(compare_networks(inputs, requests))


COUNTIES = ", ".join(str(c[0]) for c in sample.COUNTIES)


def test_sample_inputs_overlap(spark):
    requests = build.requests(spark, build.request(counties=COUNTIES))
    tables = compare_networks(sample.sample_inputs(spark), requests)
    counts = {tuple(r)[1:] for r in tables["provider_counts"].collect()}
    kinds = [*canonical.INDIVIDUAL_TYPES, canonical.HOSPITAL]
    assert len(counts) == 16
    assert {(c[2], c[4], c[5]) for c in counts} == {
        (kind, t, n) for kind, n in (("common", 12), ("unique", 6)) for t in kinds
    }
    again = compare_networks(sample.sample_inputs(spark.newSession()), requests)
    assert {tuple(r)[1:] for r in again["provider_counts"].collect()} == counts


def test_runs_replace_each_other(spark, tmp_path):
    out = str(tmp_path / "out")
    inputs = sample.sample_inputs(spark)
    both = build.requests(
        spark, build.request("R1", counties=COUNTIES), build.request("007", client="45", counties=COUNTIES), build.request("bad", counties="x")
    )
    run_comparison(inputs, both, out, "first", csv=True)
    expected = sets(compare_networks(inputs, both))
    for name, rows in expected.items():
        assert {tuple(r) for r in sinks.read_current(spark, out, name).collect()} == rows, name
    status = {r["req_id"]: (r["run_id"], r["reason"]) for r in sinks.read_status(spark, out).collect()}
    assert status == {
        "R1": ("first", None),
        "007": ("first", None),
        "bad": ("first", "county is not a number"),
    }
    # The same run again changes nothing; a later run of one request replaces only that one,
    # also where it has no rows any more.
    run_comparison(inputs, both, out, "first")
    assert {tuple(r) for r in sinks.read_current(spark, out, "provider_counts").collect()} == expected[
        "provider_counts"
    ]
    elsewhere = build.requests(spark, build.request("R1", counties="99"))
    run_comparison(inputs, elsewhere, out, "second")
    current = sinks.read_current(spark, out, "provider_counts")
    assert {r["req_id"] for r in current.collect()} == {"007"}
    csv = spark.read.csv(f"{out}/specialty_counts_csv", header=True).where("run_id LIKE 'first-%'")
    assert csv.where("request = 'R1'").count() == 20


def test_a_repeated_run_keeps_requests_it_does_not_name(spark, tmp_path):
    out = str(tmp_path / "out")
    inputs = sample.sample_inputs(spark)
    first, second = build.request("R1", counties=COUNTIES), build.request("R2", counties=COUNTIES)
    run_comparison(inputs, build.requests(spark, first, second), out, "first")
    before = sets({"c": sinks.read_current(spark, out, "provider_counts")})
    run_comparison(inputs, build.requests(spark, first), out, "first")
    assert sets({"c": sinks.read_current(spark, out, "provider_counts")}) == before


def test_quoted_cells(spark, tmp_path):
    path = tmp_path / "names.csv"
    path.write_text('a,b\n"St. ""Mary"" Hospital, Inc","12 ""A"" St, Suite 1"\n')
    schema = StructType([StructField("b", StringType()), StructField("a", StringType())])
    rows = files._csv(spark, str(path), schema).collect()
    assert [tuple(r) for r in rows] == [('12 "A" St, Suite 1', 'St. "Mary" Hospital, Inc')]


def test_export_view_files(spark, tmp_path):
    from rosterlens.operators import exports

    requests = build.requests(spark, build.request("R1", client="45", counties=COUNTIES))
    export = compare_networks(sample.sample_inputs(spark), requests)["individual_export"]
    path = str(tmp_path / "view")
    columns = exports.individual_columns(45)
    sinks.write_export_view(export, "R1", 1, columns, "Org A HMO/HMO-POS", "Org B", path)
    view = spark.read.parquet(f"{path}/parquet")
    assert "Org A HMO/HMO-POS" in view.columns and view.count() == export.count()
    assert spark.read.csv(f"{path}/csv", header=True).columns == view.columns


def test_files_with_reordered_headers(spark, tmp_path):
    cells = {"npi": "1", "Address First Line": "1 Main St", "state": "AZ", "FIPS State County Code": "4013"}
    cells |= {"Quality Score": "4.5", "Cost Score": "2", "FFS Utilization Score": "1", "MA Utilization Score": "3"}
    for number, names in enumerate((list(cells), list(cells)[::-1])):
        row = {**cells, "npi": str(number)}
        lines = [",".join(names), ",".join(row[n] for n in names)]
        (tmp_path / f"Scores for Organization - {number}.csv").write_text("\n".join(lines) + "\n")
    rows = files.organization_scores(spark, str(tmp_path)).collect()
    assert sorted((r["npi"], r["quality"], r["cost"]) for r in rows) == [(0, 4.5, 2.0), (1, 4.5, 2.0)]
    named = files.organization_scores(spark, str(tmp_path), "Scores for Organization - 1.csv")
    assert [r["npi"] for r in named.collect()] == [1]


def test_organization_files_by_their_own_headers(spark, tmp_path):
    folder = tmp_path / "network_files" / "Organization"
    folder.mkdir(parents=True)
    names = schemas.ORGANIZATION_FILE.fieldNames()
    given = {"npi": "1", "Address First Line": '"1 ""A"" St\nSuite 2, Back"', "FIPS State County Code": "25001"}
    for network, order in (("7", names), ("8", names[::-1]), ("9", [*names, "extra"])):
        cells = ",".join(given.get(n, "x") for n in order)
        (folder / f"{network}.csv").write_text(",".join(order) + "\n" + cells + "\n")
    found = files.scan_organizations(spark, str(tmp_path)).collect()
    expected = {(n, 1, 25001, '1 "A" St\nSuite 2, Back') for n in (7, 8, 9)}
    assert {(r["raw_network_id"], r["npi"], r["fips"], r["address"]) for r in found} == expected
    assert files.scan_organizations(spark, str(tmp_path), [8]).count() == 1
    assert files.scan_organizations(spark, str(tmp_path), [10]).count() == 0


def test_a_score_file_without_its_columns_is_an_error(spark, tmp_path):
    (tmp_path / "Score for Individual - X.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="County FIPS"):
        files.individual_scores(spark, str(tmp_path))
