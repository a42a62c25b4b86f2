"""Files of every client and the state of the sources, as a run writes them."""

from __future__ import annotations

import csv
import io
from pathlib import Path

import build
import pytest
from conftest import golden_rows

from rosterlens.operators import exports, sinks
from rosterlens.plans.comparison import compare_networks, run_comparison
from rosterlens.sources import files


@pytest.fixture(scope="module")
def run(spark, golden_dir, tmp_path_factory):
    """A run of three clients and of one request without any provider."""
    out = str(tmp_path_factory.mktemp("out"))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    requests = build.requests(
        spark,
        build.request("Eight", client="8"),
        build.request("Five", client="45", compares=(("2", "Org B, Inc", "100002"), ("1", "Org A", "100001"))),
        build.request("Other", client="77"),
        build.request("None", counties="1", base=("1", "Org A", "100001, 100009")),
    )
    inputs = files.read_inputs(spark, golden_dir)
    run_comparison(inputs, requests, out, "first", client_files=True)
    return out, requests, inputs


def written(out, name, request, pairing):
    """All parts of one folder in the order of their names, as rows of cells."""
    (attempt,) = Path(out, f"{name}_files").glob("run_id=*")
    parts = sorted((attempt / f"request={request}" / f"pairing={pairing}").glob("part-*"))
    text = "".join(p.read_bytes().decode() for p in parts)
    return list(csv.reader(io.StringIO(text, newline="")))


@pytest.mark.parametrize("name", ["individual_export", "organization_export"])
def test_each_client_gets_its_columns_in_order(run, name):
    out, requests, inputs = run
    export = sinks.read_current(requests.spark, out, name)
    for request, pairing, client, names in (
        ("Eight", 1, 8, ("Org A HMO/HMO-POS", "Org B HMO/HMO-POS")),
        ("Five", 1, 45, ("Org A HMO/HMO-POS", "Org B, Inc HMO/HMO-POS")),
        ("Five", 2, 45, ("Org A HMO/HMO-POS", "Org A HMO/HMO-POS (compare)")),
        ("Other", 1, 77, ("Org A HMO/HMO-POS", "Org B HMO/HMO-POS")),
        ("None", 1, 8, ("Org A HMO/HMO-POS", "Org B HMO/HMO-POS")),
    ):
        columns = sinks.CLIENT_COLUMNS[name](client)
        own = export.where(f"req_id = '{request}' and pair_idx = {pairing}")
        view = exports.export_view(exports.order_export(own), columns, *names[:1], names[1])
        expected = [["" if v is None else str(v) for v in r] for r in view.collect()]
        header, *rows = written(out, name, request, pairing)
        assert header == view.columns and set(names) <= set(header)
        assert rows == expected, (request, pairing)
    assert written(out, name, "None", 1)[1:] == []


def test_files_of_a_client_equal_the_sample_results(run):
    out, _, _ = run
    header, *rows = written(out, "individual_export", "Eight", 1)
    assert len(rows) == 130 and len(header) == len(exports.INDIVIDUAL_COLUMNS)
    keys = [header.index("NPI"), header.index("FIPS State County Code")]
    people = {(r["NPI"], r["FIPS State County Code"]) for r in golden_rows("individuals.csv")}
    assert people <= {tuple(r[k] for k in keys) for r in rows}


def test_a_run_tells_what_the_sources_held(run):
    out, requests, _ = run
    status = sinks.read_current(requests.spark, out, "source_status")
    found = {(r["req_id"], r["source"], r["raw_network_id"]): (r["n_rows"], r["status"]) for r in status.collect()}
    assert found[("Eight", "individual", 100001)] == (54, "read")
    assert found[("None", "organization", 100009)] == (0, "missing")
    assert len(found) == 2 * (2 + 2 + 2 + 3)
    assert "source_status" not in compare_networks(run[2], requests)
