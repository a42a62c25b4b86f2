"""Results of the sample request, cell by cell."""

from __future__ import annotations

import build
import pytest
from conftest import golden_rows

from rosterlens.operators import exports
from rosterlens.plans.comparison import compare_networks
from rosterlens.sources import files


@pytest.fixture(scope="module")
def tables(spark, golden_dir):
    requests = build.requests(
        spark,
        build.request("Check_1", client="8"),
        build.request("Bench_1", client="45"),
        build.request("Other_1", client="3"),
    )
    inputs = files.read_inputs(
        spark, golden_dir, requests.raw_network_ids(), requests.county_codes()
    )
    return compare_networks(inputs, requests)


def texts(rows, columns):
    return sorted(tuple("" if r[c] is None else str(r[c]) for c in columns) for r in rows)


def adopted(rows):
    """The checked-in files say 'Not Available' in some cells; the adopted text is 'NA'."""
    return [{c: "NA" if v == "Not Available" else v for c, v in row.items()} for row in rows]


def rows_of(table, req_id):
    return [r.asDict() for r in table.where(table["req_id"] == req_id).collect()]


@pytest.mark.parametrize("name", ["provider_counts", "specialty_counts"])
def test_counts(tables, name):
    expected = golden_rows(f"expected_{name}.csv")
    columns = list(expected[0])
    assert texts(rows_of(tables[name], "Check_1"), columns) == texts(expected, columns)


def test_indicators_and_market(tables):
    expected = golden_rows("expected_performance_indicators.csv")
    for row in expected:
        for column in ("Quality Score", "Cost Score", "Utilization Score"):
            row[column] = str(int(float(row[column])))
    columns = list(expected[0])
    found = rows_of(tables["performance_indicators"], "Check_1")
    assert len(found) == 36
    assert texts(found, columns) == texts(expected, columns)


def view(tables, name, req_id, client_id, columns):
    export = tables[name].where(tables[name]["req_id"] == req_id)
    return exports.export_view(
        exports.order_export(export), columns, "Org A HMO/HMO-POS", "Org B HMO/HMO-POS"
    )


def test_organization_export(tables):
    columns = exports.organization_columns(45)
    table = view(tables, "organization_export", "Bench_1", 45, columns)
    expected = adopted(golden_rows("expected_organization_export.csv"))
    assert table.columns == list(expected[0])
    found = [r.asDict() for r in table.collect()]
    assert len(found) == 24
    assert texts(found, table.columns) == texts(expected, table.columns)


def test_individual_export_of_client_45(tables):
    expected = adopted(golden_rows("expected_export_client_45.csv"))
    table = view(tables, "individual_export", "Bench_1", 45, exports.individual_columns(45))
    assert table.columns == list(expected[0])
    found = [r.asDict() for r in table.collect()]
    assert len(found) == 127
    assert texts(found, table.columns) == texts(expected, table.columns)


def test_individual_export_of_client_8(tables):
    expected = golden_rows("expected_export_client_8.csv")
    for row in expected:
        if row["Type"] == "Organization":
            row["Location Confidence Address level"] = "High"
            row["Location Confidence County Level"] = "High"
    table = view(tables, "individual_export", "Check_1", 8, exports.individual_columns(8))
    assert table.columns == list(expected[0])
    found = [r.asDict() for r in table.collect()]
    assert len(found) == 130
    assert set(texts(found, table.columns)) == set(texts(expected, table.columns))


def test_scored_rows_come_first_then_npi_order(tables):
    table = view(tables, "individual_export", "Bench_1", 45, exports.individual_columns(45))
    rows = table.collect()
    keys = [(r["Quality Score"] == "NA" and r["Cost Score"] == "NA", r["NPI"]) for r in rows]
    assert keys == sorted(keys)
    assert keys[0][0] is False and keys[-1][0] is True


def test_other_clients_see_fewer_columns(tables):
    columns = exports.individual_columns(exports.DEFAULT)
    table = view(tables, "individual_export", "Other_1", exports.DEFAULT, columns)
    assert "Address First Line" not in table.columns and "Cost Score" not in table.columns
    rows = [r.asDict() for r in table.collect()]
    assert len(rows) == len({tuple(r.values()) for r in rows})
    source = rows_of(tables["individual_export"], "Check_1")
    assert {(r["NPI"], r["County"], r["Specialty Name"]) for r in rows} == {
        (r["NPI"], r["County"], r["Specialty Name"]) for r in source
    }
