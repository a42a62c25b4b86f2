"""Broadcast hints that are given only after the size of the side was checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_LIMIT = 1_000_000
#: Distinct numbers in one broadcast of a list.
BLOCK_ROWS = 1_000_000


def small_side(side: DataFrame, rows: int, limit: int = ROW_LIMIT) -> DataFrame:
    """Hint a broadcast for a side known to hold few rows, else leave the join to Spark."""
    return F.broadcast(side) if rows <= limit else side


def blocks(listed: DataFrame, key: str, block_rows: int = BLOCK_ROWS) -> list[DataFrame]:
    """A written table of distinct keys cut by hash into parts of about ``block_rows`` rows.

    The hash spreads distinct keys evenly, so a part is close to its share of the counted rows.
    """
    parts = max(1, -(-listed.count() // block_rows))
    if parts == 1:
        return [listed]
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    return [listed.where(part == i) for i in range(parts)]


def keep_listed(rows: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
    """Rows whose key is in one of the parts, each of which is broadcast by itself."""
    if len(parts) == 1:
        return rows.join(F.broadcast(parts[0]), key, "left_semi")
    found = []
    for i, part in enumerate(parts):
        flag = f"__listed_{i}"
        rows = rows.join(F.broadcast(part.withColumn(flag, F.lit(True))), key, "left")
        found.append(flag)
    return rows.where(F.coalesce(*found, F.lit(False))).drop(*found)
