"""CSV records of files of any size, in many tasks, also where cells hold line breaks.

A file is cut into splits of even size. Whether a line break ends a record depends on the quotes
before it, back to the start of the file, so every split is first read for what it does to each
state it may begin in. These maps compose, which gives the state at the start of every split, and
then each split takes the records that begin in it, up to the first true end after its last byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.session import ship
from rosterlens.sources.catalogue import opened

SPLIT_BYTES = 1 << 25
_SPLIT = "path string, length long, low long, high long, is_first boolean"
_STATED = pa.schema(
    [("path", pa.string()), ("length", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]
    + [("is_first", pa.bool_()), ("state", pa.int32()), ("next_state", pa.int32())]
)
#: Rows of one Arrow batch, and bytes that are read at a time to find the end of a record.
BATCH_ROWS = 1 << 14
PROBE_BYTES = 1 << 16

#: At the start of a cell; within a cell without quotes; within quotes; after a quote within quotes.
START, PLAIN, QUOTED, CLOSED = range(4)

_TO_QUOTE = re.compile(rb'[^"]*+(?:""[^"]*+)*+')
_OPENING = re.compile(rb'[,\n]"')
_ENDS_CELL = b",\n"


# ---- quotes -----------------------------------------------------------------------------------


def quoted(data: bytes, state: int) -> tuple[list[tuple[int, int]], int]:
    """The ranges of the data that are within quotes, and the state after it.

    A quote opens only at the start of a cell; elsewhere in a cell without quotes it is a
    character. Within quotes two quotes are one, and one ends them.
    """
    n, at, found = len(data), 0, []
    if state == CLOSED and n:
        # The quote before the data was the first of two, or it closed.
        at = 1
        state = QUOTED if data[:1] == b'"' else START if data[0] in _ENDS_CELL else PLAIN
    while at < n:
        if state == QUOTED:
            end = _TO_QUOTE.match(data, at).end()
            found.append((at, end))
            if end == n:
                return found, QUOTED
            at, state = end + 1, CLOSED
        elif state == START and data[at] == 34:
            at, state = at + 1, QUOTED
        else:
            opening = _OPENING.search(data, at)
            if opening is None:
                return found, START if data[-1] in _ENDS_CELL else PLAIN
            at, state = opening.end(), QUOTED
    return found, state


def record_ends(data: bytes, state: int) -> tuple[np.ndarray, int]:
    """The places after the line breaks that end a record, and the state after the data."""
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    ranges, state = quoted(data, state)
    if ranges:
        starts, ends = np.array(ranges).T
        before = np.searchsorted(starts, breaks, side="right") - 1
        breaks = breaks[(before < 0) | (breaks >= ends[before])]
    return breaks + 1, state


def transitions(data: bytes) -> list[int]:
    """The state after the data for every state before it."""
    return [quoted(data, state)[1] for state in range(4)]


def _first_end(file: pa.NativeFile, offset: int, state: int, length: int) -> int:
    """Where the first record that begins after the offset begins; the length if none does."""
    size = PROBE_BYTES
    while offset < length:
        file.seek(offset)
        data = file.read(min(size, length - offset))
        ends, state = record_ends(data, state)
        if len(ends):
            return offset + int(ends[0])
        offset, size = offset + len(data), 2 * size
    return length


# ---- splits -----------------------------------------------------------------------------------


def _with_states(splits: DataFrame) -> DataFrame:
    """The splits of large files with the states before and after each."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                with opened(row["path"]) as file:
                    file.seek(row["low"])
                    row["after"] = transitions(file.read(row["high"] - row["low"]))
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    def composed(table: pa.Table) -> pa.Table:
        rows, state = sorted(table.to_pylist(), key=lambda r: r["low"]), START
        for row in rows:
            row["state"], state = state, row.pop("after")[state]
            row["next_state"] = state
        return pa.Table.from_pylist(rows, _STATED)

    maps = splits.mapInArrow(mapped, f"{_SPLIT}, after array<long>")
    # One row of a few numbers per split of a file.
    return maps.groupBy("path").applyInArrow(composed, f"{_SPLIT}, state int, next_state int")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that begin in each split, as text without their line end; empty lines go."""
    for batch in batches:
        for row in batch.to_pylist():
            with opened(row["path"]) as file:
                first = row["low"] if row["is_first"] else _first_end(file, row["low"], row["state"], row["length"])
                last = _first_end(file, row["high"], row["next_state"], row["length"])
                if last <= first:
                    continue
                file.seek(first)
                data = file.read(last - first)
            ends, _ = record_ends(data, START)
            if not len(ends) or ends[-1] < len(data):
                ends = np.append(ends, len(data))
            starts = np.concatenate([[0], ends[:-1]])
            for low in range(0, len(ends), BATCH_ROWS):
                lines = [
                    data[a:b].rstrip(b"\r\n").decode("utf-8", "replace")
                    for a, b in zip(starts[low : low + BATCH_ROWS], ends[low : low + BATCH_ROWS])
                ]
                lines = [line for line in lines if line]
                yield pa.RecordBatch.from_pydict({"path": pa.array([row["path"]] * len(lines), pa.string()), "record": pa.array(lines, pa.string())})


def records(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``path, record`` of files given as ``path, body, length``.

    A file of one split is read once. A larger one is read a second time for its quotes, and only
    four small numbers per split are exchanged. A task holds one split, or a record if that is
    longer.
    """
    spark = files.sparkSession
    ship(spark)
    size = F.lit(split_bytes)
    n = F.greatest(F.ceil((F.col("length") - F.col("body")) / size), F.lit(1)).cast("int")
    low = F.col("body") + F.col("split") * size
    tasks = spark.sparkContext.defaultParallelism
    splits = (
        files.where("length > body")
        .select("path", "length", "body", F.explode(F.sequence(F.lit(0), n - 1)).alias("split"))
        .select(
            "path",
            F.col("length").cast("long").alias("length"),
            low.cast("long").alias("low"),
            F.least(low + size, "length").cast("long").alias("high"),
            (F.col("split") == 0).alias("is_first"),
        )
        .repartition(tasks, "path", "low")
    )
    whole = F.col("is_first") & (F.col("high") == F.col("length"))
    at_start = F.lit(START)
    small = splits.where(whole).select("*", at_start.alias("state"), at_start.alias("next_state"))
    large = _with_states(splits.where(~whole)).repartition(tasks, "path", "low")
    return small.unionByName(large).mapInArrow(_cut, "path string, record string")
