"""Requests about several data releases in one job, each answered from its own release only.

    <data_root>/<release>/network_files/...

A request names its release, the folder of the data it was made for. Raw networks have the same ids
in every release, so the rows of two releases are never put into one table: the requests of a
release are evaluated on its inputs, and the outputs are joined as unions. Releases are few, each a
delivery of data; requests, pairings and rows are not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from rosterlens.operators import counts
from rosterlens.operators.sinks import write_run
from rosterlens.plans.comparison import compare_networks, run_tables
from rosterlens.session import prepare
from rosterlens.sources import catalogue
from rosterlens.sources.files import Inputs, read_inputs
from rosterlens.sources.requests import Requests

NO_FILES = "data release has no files"


def read_releases(
    requests: Requests, data_root: str, **options
) -> tuple[list[tuple[Requests, Inputs]], Requests]:
    """The requests and inputs of every release, and all requests.

    The root of a release is given by the table ``Requests`` was made with, or is its folder below
    the data root. Requests about a release without files are rejected. Each release reads the
    files of the networks that its own requests name. ``options`` are those of ``read_inputs``.
    """
    roots = {
        release: root or (f"{data_root}/{release}" if release else data_root)
        for release, root in requests.release_roots().items()
    }
    missing = [release for release, root in roots.items() if catalogue.file_table(requests.spark, root) is None]
    requests = requests.reject_releases(missing, NO_FILES)
    parts = []
    for release, root in roots.items():
        if release not in missing:
            own = requests.of_release(release)
            parts.append((own, read_inputs(requests.spark, root, requests=own, **options)))
    return parts, requests


def _united(parts: list[dict[str, DataFrame]]) -> dict[str, DataFrame]:
    return {name: reduce(DataFrame.unionByName, [p[name] for p in parts]) for name in parts[0]} if parts else {}


def compare_releases(
    parts: list[tuple[Requests, Inputs]],
    suppressed: list[int] = counts.SUPPRESSED_NETWORKS,
    fill_blanks: bool = False,
) -> dict[str, DataFrame]:
    """All outputs by name, of the parts that ``read_releases`` gives."""
    return _united([compare_networks(inputs, own, suppressed, fill_blanks) for own, inputs in parts])


def run_releases(
    requests: Requests,
    data_root: str,
    out_dir: str,
    run_id: str,
    suppressed: list[int] = counts.SUPPRESSED_NETWORKS,
    fill_blanks: bool = False,
    csv: bool = False,
    client_files: bool = False,
    **options,
) -> Requests:
    """Evaluate the requests of all releases and write every output; the requests with what was rejected."""
    prepare(requests.spark)
    parts, requests = read_releases(requests, data_root, **options)
    tables = _united([run_tables(inputs, own, suppressed, fill_blanks) for own, inputs in parts])
    write_run(tables, requests, out_dir, run_id, csv, client_files)
    return requests
