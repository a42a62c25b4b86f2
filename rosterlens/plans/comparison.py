"""A whole comparison: every output of every request from one set of inputs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from rosterlens.operators import counts, exports, indicators
from rosterlens.operators.lineage import cut_lineage
from rosterlens.operators.sinks import write_run
from rosterlens.session import prepare
from rosterlens.sources.files import Inputs
from rosterlens.sources.requests import Requests
from rosterlens.sources.status import request_source_status

_INDIVIDUAL_COLUMNS = ["raw_network_id", *indicators.INDIVIDUAL_ROW]
_ORGANIZATION_COLUMNS = ["raw_network_id", *indicators.ORGANIZATION_ROW]


def requested_inputs(inputs: Inputs, requests: Requests) -> Inputs:
    """The distinct requested rows in the few columns that counts and indicators use."""
    return replace(
        inputs,
        individuals=requests.restrict(inputs.individuals).select(*_INDIVIDUAL_COLUMNS).distinct(),
        organizations=requests.restrict(inputs.organizations)
        .select(*_ORGANIZATION_COLUMNS)
        .distinct(),
    )


def aggregate_tables(
    inputs: Inputs,
    requests: Requests,
    suppressed: list[int] = counts.SUPPRESSED_NETWORKS,
    fill_blanks: bool = False,
) -> dict[str, DataFrame]:
    """The count, specialty and indicator tables.

    ``fill_blanks`` adds rows without a count for pairings that have no individual, no
    organization or no allow-listed provider at all.
    """
    individual = counts.individual_counts(inputs.individuals, requests)
    organization = counts.organization_counts(inputs.organizations, requests)
    specialty = counts.specialty_counts(inputs.individuals, inputs.specialties, requests)
    if fill_blanks:
        individual = counts.fill_blank_pairings(individual, counts.individual_flags(), requests)
        organization = counts.fill_blank_pairings(
            organization, counts.organization_flags(), requests
        )
        specialty = counts.fill_blank_pairings(
            specialty, counts.specialty_flags(inputs.specialties), requests
        )
    return {
        "provider_counts": individual.unionByName(organization).unionByName(
            counts.suppressed_rows(requests, suppressed)
        ),
        "specialty_counts": specialty,
        "performance_indicators": indicators.performance_indicators(
            inputs.individuals,
            inputs.individual_scores,
            inputs.organizations,
            inputs.organization_scores,
            inputs.market,
            requests,
        ),
    }


def hospital_rows(inputs: Inputs, requests: Requests) -> DataFrame:
    return exports.hospital_rows(
        inputs.organizations, inputs.organization_scores, inputs.hospital_names, requests
    )


def export_tables(
    inputs: Inputs, requests: Requests, hospitals: DataFrame
) -> dict[str, DataFrame]:
    """The two row-level exports, with the columns of all clients."""
    return {
        "organization_export": exports.organization_export(hospitals, requests),
        "individual_export": exports.individual_export(
            inputs.individuals, inputs.individual_scores, hospitals, requests
        ),
    }


def compare_networks(
    inputs: Inputs,
    requests: Requests,
    suppressed: list[int] = counts.SUPPRESSED_NETWORKS,
    fill_blanks: bool = False,
) -> dict[str, DataFrame]:
    """All outputs by name; nothing runs until one of them is used."""
    return {
        **aggregate_tables(inputs, requests, suppressed, fill_blanks),
        **export_tables(inputs, requests, hospital_rows(inputs, requests)),
    }


def run_tables(
    inputs: Inputs,
    requests: Requests,
    suppressed: list[int] = counts.SUPPRESSED_NETWORKS,
    fill_blanks: bool = False,
) -> dict[str, DataFrame]:
    """All outputs for a run that writes every one of them.

    What several outputs share is written once: the requested rows in the few columns the
    three aggregate tables use, and the hospital rows that go into both exports.
    """
    reduced = requested_inputs(inputs, requests)
    reduced = replace(
        reduced,
        individuals=cut_lineage(reduced.individuals),
        organizations=cut_lineage(reduced.organizations),
    )
    tables = {
        **aggregate_tables(reduced, requests, suppressed, fill_blanks),
        **export_tables(inputs, requests, cut_lineage(hospital_rows(inputs, requests))),
    }
    if inputs.raw_individuals is not None and inputs.raw_organizations is not None:
        tables["source_status"] = request_source_status(
            requests, inputs.raw_individuals, inputs.raw_organizations
        )
    return tables


def run_comparison(
    inputs: Inputs,
    requests: Requests,
    out_dir: str,
    run_id: str,
    suppressed: list[int] = counts.SUPPRESSED_NETWORKS,
    fill_blanks: bool = False,
    csv: bool = False,
    client_files: bool = False,
) -> None:
    """Evaluate all requests and write every output under ``out_dir``.

    ``client_files`` adds the exports as clients get them, see ``sinks.write_client_files``. Of
    inputs read from files, the run also tells what the sources of each request held.
    """
    prepare(requests.spark)
    tables = run_tables(inputs, requests, suppressed, fill_blanks)
    write_run(tables, requests, out_dir, run_id, csv, client_files)
