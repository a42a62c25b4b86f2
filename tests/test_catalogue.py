"""Source files that differ in types and columns, and CSV records in splits of any size."""

from __future__ import annotations

import csv
import io
import random

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rosterlens import schemas
from rosterlens.sources import catalogue, files, records


def person(**given) -> dict:
    row = {n: f"x {n}" for n in schemas.INDIVIDUAL_FILE.fieldNames()}
    row |= {"npi": 1, "network_id": 7, "FIPS State County Code": 6037, "Affiliation ID": 700000}
    return {**row, "New Flag": "PCP", "location_confidence": "High", **given}


def write(folder, network, code, rows, **types):
    path = folder / "network_files" / "Individual" / str(network)
    path.mkdir(parents=True, exist_ok=True)
    table = pa.Table.from_pandas(pd.DataFrame(rows), preserve_index=False)
    for name, kind in types.items():
        at = table.schema.get_field_index(name)
        table = table.set_column(at, name, table.column(name).cast(kind))
    pq.write_table(table, path / f"{code}.parquet")


def test_types_may_differ_between_files(spark, tmp_path):
    write(tmp_path, 7, 90001, [person()])
    write(tmp_path, 7, 90002, [person(npi=2, **{"Affiliation ID": 700001.0}), person(npi=3, **{"Affiliation ID": float("nan")})])
    write(tmp_path, 7, 90003, [person(npi=4, specialty_code=90003, **{"FIPS State County Code": "06037"})])
    write(tmp_path, 8, 90001, [person(npi="5", **{"FIPS State County Code": "no county", "Affiliation ID": None})])
    lacking = person(npi=6, zip_code=1234.0)
    del lacking["Is_Dual_Provider"], lacking["city"]
    write(tmp_path, 8, 90002, [lacking], npi=pa.int32(), zip_code=pa.float32())
    write(tmp_path, 8, 25270, [{"npi": [1, 2]}])
    rows = {r["npi"]: r for r in files.scan_individuals(spark, str(tmp_path)).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6]
    assert [rows[i]["raw_network_id"] for i in range(1, 7)] == [7, 7, 7, 7, 8, 8]
    assert [rows[i]["group_tin"] for i in range(1, 7)] == ["700000", "700001", None, "700000", None, "700000"]
    assert [rows[i]["fips"] for i in range(1, 7)] == [6037, 6037, 6037, 6037, None, 6037]
    assert rows[4]["specialty_code"] == "90003" and rows[6]["zip_code"] == "1234"
    assert rows[6]["city"] is None and rows[6]["is_dual_provider"] is None and rows[1]["city"] == "x city"
    assert files.scan_individuals(spark, str(tmp_path)).schema == schemas.INDIVIDUALS


def test_fractions_and_other_numbers_are_no_identifiers(spark, tmp_path):
    write(tmp_path, 7, 90001, [person(npi=1.5), person(npi=2.0)])
    assert [r["npi"] for r in files.scan_individuals(spark, str(tmp_path)).orderBy("npi").collect()] == [None, 2]


def test_footers_tell_types_and_rows(spark, tmp_path):
    write(tmp_path, 7, 90001, [person(), person(npi=2)])
    write(tmp_path, 7, 90002, [person(npi="3")])
    root = f"{tmp_path}/network_files/Individual"
    found = catalogue.parquet_footers(catalogue.file_table(spark, root), root, ["npi", "city"])
    assert sorted((r["row_groups"], r["n_rows"]) for r in found.collect()) == [(1, 1), (1, 2)]
    groups = catalogue.by_signature(found)
    assert [columns for columns, _ in groups] == [["city", "npi"]] * 2
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.parquet").write_text("no footer")
    with pytest.raises(Exception, match="no parquet file"):
        catalogue.parquet_footers(catalogue.file_table(spark, f"{tmp_path}/bad"), f"{tmp_path}/bad", ["npi"]).collect()


def test_tables_of_networks_choose_the_files(spark, tmp_path):
    for network in (7, 8, 9):
        write(tmp_path, network, 90001, [person(npi=network)])
    wanted = spark.createDataFrame([(7,), (9,), (9,), (10,)], "raw_network_id long")
    rows = files.scan_individuals(spark, str(tmp_path), wanted)
    assert sorted(r["npi"] for r in rows.collect()) == [7, 9]
    execution = rows._jdf.queryExecution()
    execution.toRdd().count()
    assert execution.executedPlan().collectLeaves().head().metrics().get("numFiles").get().value() == 2


def test_only_the_head_of_a_csv_file_is_read(spark, tmp_path, monkeypatch):
    body = "\n".join(f"{i},x" for i in range(2000))
    (tmp_path / "a.csv").write_text("﻿\n a ,\"b \"\"c\"\"\nd\"\r\n" + body)
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text(",".join(f"column {i}" for i in range(40)))
    reads = []

    class Counted:
        def __init__(self, file):
            self.file = file

        def seek(self, at):
            self.file.seek(at)

        def read(self, n):
            reads.append(n)
            return self.file.read(n)

    monkeypatch.setattr(catalogue, "HEAD_BYTES", 64)
    found = {}
    for path in sorted(tmp_path.iterdir()):
        with catalogue.opened(str(path)) as file:
            found[path.name] = catalogue._header(str(path), Counted(file))
    assert found["a.csv"]["header"] == ["a", 'b "c"\nd'] and reads[0] == 64 and len(reads) == 6
    assert (tmp_path / "a.csv").read_bytes()[found["a.csv"]["body"] :].decode() == body
    assert found["b.csv"] == {"header": [], "body": 0}
    assert len(found["c.csv"]["header"]) == 40
    heads = catalogue.csv_headers(catalogue.file_table(spark, str(tmp_path)), str(tmp_path))
    # Spark does not list empty files.
    assert {len(r["header"]) for r in heads.collect()} == {2, 40}


def random_csv(rng, n):
    """Records with quotes, line breaks and commas in cells, and quotes within plain cells."""
    cells = ["", "x", 'a"b', "plain text", '""', "é"]
    quoted = ["", "x", "a,b", "line\nbreak", 'say ""hi""', '""', "\n\n", ',"" ""\n']
    lines = []
    for i in range(n):
        row = [str(i)] + [
            f'"{rng.choice(quoted)}"' if rng.random() < 0.5 else rng.choice(cells[:4] + cells[5:]) for _ in range(2)
        ]
        lines.append(",".join(row))
    return "\n".join(lines) + rng.choice(["", "\n", "\n\n"])


def test_states_compose():
    rng = random.Random(3)
    for _ in range(60):
        data = random_csv(rng, 6).encode()
        whole = records.transitions(data)
        cut = rng.randrange(len(data))
        first, second = records.transitions(data[:cut]), records.transitions(data[cut:])
        assert [second[s] for s in first] == whole
        ends, _ = records.record_ends(data, records.START)
        parts = [data[a:b] for a, b in zip([0, *ends], [*ends, len(data)])]
        rows = [r for p in parts if p.strip(b"\n") for r in csv.reader(io.StringIO(p.decode(), newline=""))]
        assert rows == [r for r in csv.reader(io.StringIO(data.decode(), newline="")) if r]


@pytest.mark.parametrize("split", [3, 17, 1 << 25])
def test_records_do_not_depend_on_splits(spark, tmp_path, split):
    rng = random.Random(split)
    expected, table = [], []
    for k in range(4):
        data = random_csv(rng, 40 * k)
        path = tmp_path / f"{k}.csv"
        path.write_bytes(b"h,i,j\n" + data.encode())
        table.append((str(path), 6, len(data.encode()) + 6))
        expected += [(str(path), *r) for r in csv.reader(io.StringIO(data, newline="")) if r]
    rows = records.records(spark.createDataFrame(table, "path string, body long, length long"), split)
    found = []
    for path, record in rows.collect():
        found += [(path, *r) for r in csv.reader(io.StringIO(record, newline=""))]
    assert sorted(found) == sorted(expected)


def test_a_large_file_with_line_breaks_is_many_tasks(spark, tmp_path, monkeypatch):
    folder = tmp_path / "network_files" / "Organization"
    folder.mkdir(parents=True)
    names = schemas.ORGANIZATION_FILE.fieldNames()
    with open(folder / "7.csv", "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(names)
        for i in range(3000):
            given = {"npi": i, "FIPS State County Code": 6037, "Address First Line": f'{i} "A" St\nSuite, {i % 7}'}
            writer.writerow([given.get(n, "x") for n in names])
    monkeypatch.setattr(records, "records", lambda table, whole=records.records: whole(table, 10_000))
    rows = files.scan_organizations(spark, str(tmp_path))
    found = {(r["npi"], r["address"]) for r in rows.collect()}
    assert found == {(i, f'{i} "A" St\nSuite, {i % 7}') for i in range(3000)} and rows.count() == 3000
    used = {r[0] for r in rows.selectExpr("spark_partition_id()").distinct().collect()}
    assert len(used) > 2
