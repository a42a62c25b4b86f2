"""Write outputs by request so that a repeated run replaces what it wrote before.

    <out_dir>/<output>/run_id=<run_id>-<attempt>/request=<req_id>/...
    <out_dir>/<export>_files/run_id=<run_id>-<attempt>/request=<req_id>/pairing=<n>/...
    <out_dir>/request_status/request=<req_id>/...

Every attempt of a run writes to a folder of its own. The status rows are written last and name
the attempt that holds the current results of a request, so readers never see half of a run, a
request that has no rows any more does not keep old ones, and a run that is repeated for some of
its requests leaves the results of the others as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.operators.exports import (
    CLIENTS,
    DEFAULT,
    IN_BASE,
    IN_COMPARE,
    IS_SCORED,
    export_view,
    individual_columns,
    order_columns,
    order_export,
    organization_columns,
)
from rosterlens.sources.requests import Requests

STATUS = "request_status"
#: The columns that each client is shown of an export.
CLIENT_COLUMNS = {
    "individual_export": individual_columns,
    "organization_export": organization_columns,
}
_CSV_LINE = {"escape": '"', "emptyValue": ""}


def _write(table: DataFrame, path: str, file_format: str, mode: str = "static") -> None:
    (
        table.withColumn("request", F.col("req_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("header", True)
        .option("escape", '"')
        .partitionBy("request")
        .format(file_format)
        .save(path)
    )


def _in_order(export: DataFrame) -> DataFrame:
    """Ordered files of even size, also if one request has most of the rows."""
    columns = ["req_id", "pair_idx", *order_columns(export)]
    return export.repartitionByRange(*columns).sortWithinPartitions(*columns)


def write_run(
    tables: dict[str, DataFrame],
    requests: Requests,
    out_dir: str,
    run_id: str,
    csv: bool = False,
    client_files: bool = False,
) -> None:
    """Write the outputs of one run, then make it the current run of its requests.

    The parts of an ordered CSV output are in order by their names.
    """
    if not run_id[:1].isalpha():
        raise ValueError("a run id starts with a letter")
    spark = requests.spark
    attempt = f"{run_id}-{uuid.uuid4().hex[:12]}"
    for name, table in tables.items():
        path = f"{out_dir}/{name}/run_id={attempt}"
        ordered = _in_order(table) if IS_SCORED in table.columns else table
        _write(ordered, path, "parquet")
        if csv:
            written = spark.read.schema(ordered.schema).parquet(path)
            if IS_SCORED in written.columns:
                written = _in_order(written)
            _write(written, f"{out_dir}/{name}_csv/run_id={attempt}", "csv")
        if client_files and name in CLIENT_COLUMNS:
            written = spark.read.schema(ordered.schema).parquet(path)
            write_client_files(written, CLIENT_COLUMNS[name], requests, f"{out_dir}/{name}_files/run_id={attempt}")
    done = requests.accepted.select("req_id", F.lit(None).cast("string").alias("reason"))
    status = done.unionByName(requests.rejected).select(
        "*", F.lit(run_id).alias("run_id"), F.lit(attempt).alias("attempt")
    )
    _write(status.where(F.col("req_id").isNotNull()), f"{out_dir}/{STATUS}", "parquet", "dynamic")


def read_status(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current run of every request, and why a request was rejected."""
    return spark.read.parquet(f"{out_dir}/{STATUS}").select("req_id", "run_id", "reason")


def read_current(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """Rows of one output, each request from its current run."""
    status = spark.read.parquet(f"{out_dir}/{STATUS}").where("reason is null")
    current = status.select("req_id", F.col("attempt").alias("run_id"))
    rows = spark.read.parquet(f"{out_dir}/{name}").drop("request")
    return rows.join(current, ["req_id", "run_id"], "left_semi").drop("run_id")


def write_export_view(
    export: DataFrame,
    req_id: str,
    pair_idx: int,
    columns: list[str],
    base_name: str,
    compare_name: str,
    path: str,
) -> None:
    """One pairing in the columns of its client, as CSV and parquet, in export order."""
    pairing = export.where((F.col("req_id") == req_id) & (F.col("pair_idx") == pair_idx))
    view = export_view(order_export(pairing), columns, base_name, compare_name)
    view.write.mode("overwrite").parquet(f"{path}/parquet")
    view.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/csv")


def _of_client(line: Callable[[int], Column]) -> Column:
    """The value for the client of a row; all but the listed ones are alike."""
    value = line(DEFAULT)
    for client in CLIENTS:
        value = F.when(F.col("client_id") == client, line(client)).otherwise(value)
    return value


def write_client_files(
    export: DataFrame, columns: Callable[[int], list[str]], requests: Requests, path: str
) -> None:
    """The export of every pairing as its client gets it: ``request=<id>/pairing=<n>/part-...``.

    Each folder holds CSV in the columns of the client, under a header in which the flags have the
    names of the two plans. All pairings are written in one pass, as lines: a large one is many
    parts, and its parts in the order of their names are one file in export order with the header
    first. A pairing without rows is a header.
    """
    plans = F.when(F.col("base_name") == F.col("compare_name"), F.concat("compare_name", F.lit(" (compare)")))
    names = {IN_BASE: F.col("base_name"), IN_COMPARE: plans.otherwise(F.col("compare_name"))}

    def header(client: int) -> Column:
        cells = [names.get(c, F.lit(c)).alias(f"c{i}") for i, c in enumerate(columns(client))]
        return F.to_csv(F.struct(*cells), _CSV_LINE)

    def row(client: int) -> Column:
        return F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns(client)]), _CSV_LINE)

    order = order_columns(export)
    keys = [f"__order_{i}" for i in range(len(order))]
    lines = export.select(
        "req_id",
        "pair_idx",
        F.lit(1).alias("__kind"),
        # Ascending, so that headers with null keys stay first whatever the key.
        (~F.col(IS_SCORED)).alias(keys[0]),
        *[key.alias(name) for name, key in zip(keys[1:], order[1:])],
        _of_client(row).alias("value"),
    )
    headers = requests.pairs.select("req_id", "pair_idx", F.lit(0).alias("__kind"), _of_client(header).alias("value"))
    sorting = ["req_id", "pair_idx", "__kind", *keys]
    (
        lines.unionByName(headers, allowMissingColumns=True)
        .repartitionByRange(*sorting)
        .sortWithinPartitions(*sorting)
        .select(F.col("req_id").alias("request"), F.col("pair_idx").alias("pairing"), "value")
        .write.mode("overwrite")
        .option("compression", "none")
        .partitionBy("request", "pairing")
        .text(path)
    )
