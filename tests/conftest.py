from __future__ import annotations

import csv
import shutil
import sys
from pathlib import Path

import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from session import local_session  # noqa: E402

GOLDEN = Path(__file__).resolve().parent / "golden"

_CODES = {"PCP": "90001", "Physician Specialists": "90002", "Other Providers": "90003"}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session()
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


def golden_rows(name: str) -> list[dict[str, str]]:
    with open(GOLDEN / name, newline="") as file:
        return list(csv.DictReader(file))


def individual_frame() -> pd.DataFrame:
    """The golden individuals under the column names of the source files."""
    rows = pd.read_csv(GOLDEN / "individuals.csv", dtype=str)
    return pd.DataFrame(
        {
            "raw_network_id": rows["raw_network_id"],
            "npi": rows["NPI"].astype("int64"),
            "type": "Individual",
            "presentation_name": rows["Presentation Name"],
            "first_name": rows["First Name"],
            "last_name": rows["Last Name"],
            "network_id": rows["raw_network_id"].astype("int64"),
            "network_name": "overwritten",
            "Address First Line": rows["Address First Line"],
            "Parent_Organization": "Org",
            "location_confidence": rows["Location Confidence County Level"],
            "location_confidence_address_level": rows["Location Confidence Address level"],
            "specialty_category": rows["Provider Type"],
            "specialty_name": rows["Specialty Name"],
            "specialty_subspecialty": rows["Specialty Name"],
            "specialty_code": rows["Provider Type"].map(_CODES),
            "Specialty Flag": rows["Specialty Flag"],
            "New Flag": rows["Provider Type"],
            "city": rows["City"],
            "state": rows["State"],
            "zip_code": rows["Zip Code"],
            "county_name": rows["County"],
            "FIPS State County Code": rows["FIPS State County Code"].astype("int64"),
            "Specialty Description": rows["Specialty Name"],
            "Is_Dual_Provider": "N",
            "Affiliation ID": rows["Group TIN"].astype("int64"),
            "Affiliation Presentation Name": rows["Group Name"],
        }
    )


@pytest.fixture(scope="session")
def golden_dir(tmp_path_factory) -> str:
    """The golden tables in the directory layout of the source files."""
    root = tmp_path_factory.mktemp("data")
    people = individual_frame()
    for (network, code), part in people.groupby(["raw_network_id", "specialty_code"]):
        folder = root / "network_files" / "Individual" / network
        folder.mkdir(parents=True, exist_ok=True)
        part.drop(columns="raw_network_id").to_parquet(folder / f"{code}.parquet", index=False)
    # A file with an excluded code: one base provider as if it were in the other network.
    extra = people[people["raw_network_id"] == "100001"].head(3).drop(columns="raw_network_id")
    extra.to_parquet(
        root / "network_files" / "Individual" / "100002" / "25270.parquet", index=False
    )
    organizations = root / "network_files" / "Organization"
    organizations.mkdir(parents=True)
    for network in ("100001", "100002"):
        shutil.copy(GOLDEN / f"organizations_{network}.csv", organizations / f"{network}.csv")
    for source, target in (
        ("individual_scores.csv", "Score for Individual - Some Payer.csv"),
        ("organization_scores.csv", "Scores for Organization - Some Payer.csv"),
        ("specialties.csv", "HSD_specialty.csv"),
        ("hospital_names.csv", "Hospital_name_mapping.csv"),
        ("market.csv", "network_performance_countywise.csv"),
        ("market_hospital.csv", "network_performance_countywise_hospital.csv"),
    ):
        shutil.copy(GOLDEN / source, root / target)
    return str(root)
