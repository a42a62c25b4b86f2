"""A catalogue of source files: one row per file, from its first or last bytes only.

Parquet files tell their column types in the footer, CSV files their columns in the first record.
Both are read in tasks, as a range of some kilobytes per file, so that files whose types or
columns differ can be read in groups that agree. Stores that Arrow cannot open are read through
Spark, which then gives the whole content of every file to a task.
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.session import ship

#: So much of a CSV file is read for its header; a longer header is read in twice as much.
HEAD_BYTES = 1 << 16

QUOTE, NEWLINE = b'"', b"\n"
_ARROW = {"string": pa.string(), "long": pa.int64(), "array<string>": pa.list_(pa.string())}


# ---- files ------------------------------------------------------------------------------------


def file_table(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame | None:
    """``path`` and ``length`` of the files in a folder or of a pattern; None if there is no such path.

    Only names and sizes are listed, no content is read.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern)
            .load(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return files


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a path as Spark lists it, and the name of the file there."""
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/@?=&%"))


def is_reachable(path: str) -> bool:
    """Whether Arrow knows the store of a path."""
    try:
        located(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


@contextmanager
def opened(path: str, content: bytes | None = None) -> Iterator[pa.NativeFile]:
    """A file for reads at any place; its content if that was read already."""
    if content is not None:
        with pa.BufferReader(content) as file:
            yield file
        return
    store, name = located(path)
    with store.open_input_file(name) as file:
        yield file


def _looked_into(files: DataFrame, root: str, look: Callable[[str, pa.NativeFile], dict], schema: str) -> DataFrame:
    """What a function finds in every file, as ``path`` and the columns of the schema."""
    spark = files.sparkSession
    ship(spark)
    columns = ["path"] if is_reachable(root) else ["path", "content"]
    columns_found = [part.split() for part in f"path string, {schema}".split(", ")]
    arrow = pa.schema([(name, _ARROW[kind]) for name, kind in columns_found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                with opened(row["path"], row.get("content")) as file:
                    rows.append({"path": row["path"], **look(row["path"], file)})
            yield pa.RecordBatch.from_pylist(rows, arrow)

    tasks = max(1, spark.sparkContext.defaultParallelism)
    spread = files.select(*columns).repartition(tasks) if columns == ["path"] else files.select(*columns)
    return spread.mapInArrow(run, f"path string, {schema}")


# ---- parquet ----------------------------------------------------------------------------------


def parquet_footers(files: DataFrame, root: str, columns: list[str]) -> DataFrame:
    """Per parquet file its ``signature``, ``row_groups`` and ``n_rows``.

    The signature is a JSON object of the stored types of the given columns that the file has.
    A column without any value may be stored without a type; it counts as absent.
    """
    wanted = set(columns)

    def look(path: str, file: pa.NativeFile) -> dict:
        from pyarrow import parquet

        try:
            found = parquet.ParquetFile(file)
        except pa.ArrowInvalid as error:
            raise ValueError(f"no parquet file: {path}") from error
        types = {}
        for i in range(len(found.schema)):
            column = found.schema.column(i)
            if column.path in wanted and column.logical_type.type != "NULL":
                types[column.path] = f"{column.physical_type} {column.logical_type}"
        return {
            "signature": json.dumps(types, sort_keys=True),
            "row_groups": found.metadata.num_row_groups,
            "n_rows": found.metadata.num_rows,
        }

    return _looked_into(files, root, look, "signature string, row_groups long, n_rows long")


def by_signature(footers: DataFrame) -> list[tuple[list[str], list[str]]]:
    """Columns and paths of the files of every signature: one short row per file, as a listing has."""
    groups: dict[str, list[str]] = {}
    for row in footers.select("signature", "path").orderBy("path").collect():
        groups.setdefault(row["signature"], []).append(row["path"])
    return [(list(json.loads(signature)), groups[signature]) for signature in sorted(groups)]


# ---- CSV --------------------------------------------------------------------------------------


def _header(path: str, file: pa.NativeFile) -> dict:
    """The first record that is not empty, and where the data begins."""
    size = HEAD_BYTES
    while True:
        file.seek(0)
        head = file.read(size)
        complete = len(head) < size
        start = 3 if head.startswith(b"\xef\xbb\xbf") else 0
        while head[start : start + 1] in (b"\r", NEWLINE) and start < len(head):
            start += 1
        end = start
        while True:
            end = head.find(NEWLINE, end)
            if end < 0 or head.count(QUOTE, start, end) % 2 == 0:
                break
            end += 1
        if end >= 0 or complete:
            break
        size *= 2
    line = head[start : end if end >= 0 else len(head)].decode("utf-8", "replace").rstrip("\r")
    cells = next(csv.reader(io.StringIO(line, newline="")), []) if line.strip() else []
    return {"header": [c.strip() for c in cells], "body": end + 1 if end >= 0 else len(head)}


def csv_headers(files: DataFrame, root: str) -> DataFrame:
    """Per CSV file its ``header``, the names of its columns, and ``body``, where its data begins.

    An empty file has no names. The byte order mark is not part of a name.
    """
    return _looked_into(files, root, _header, "header array<string>, body long")
