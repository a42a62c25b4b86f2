"""Best-fit packing in rounds: partitions pack, nearly full bins leave, the rest merge as items.

Every round deals its items to groups of bounded size and packs each group best-fit, largest
first. A bin that no later round could fill leaves with its sequence. Of the others a group hands
on those at most half full, of which best fit leaves one at most, and as many of its emptiest
bins as later rounds could put such a bin into. So what is handed on depends on the number of
groups, not of documents, and no possible merge is lost.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.common import prepare, stored, whole_texts

CAPACITY = 2048
END_ID = 0
GROUP_ITEMS = 50_000
FAN_IN = 8
_ID_BITS = 40


# ---- pieces -----------------------------------------------------------------------------------


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of n tokens: all full but the first."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return [first] * (first > 0) + [capacity] * (n // capacity)


@cache
def _tokenizer(file: str):
    """The byte-level vocabulary; strings of special tokens stand for their ids."""
    import json

    import public_tokenizers
    import tiktoken

    from rosterlens.llm.bpe import read_ranks

    with open(public_tokenizers.path(file + ".json")) as lines:
        special = {t["content"]: t["id"] for t in json.load(lines)["added_tokens"]}
    ranks = read_ranks(public_tokenizers.path(file + ".tiktoken"))
    ranks = {token: rank for token, rank in ranks.items() if rank not in special.values()}
    return tiktoken.Encoding(
        file, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


def pieces(docs: DataFrame, capacity: int = CAPACITY, file: str = "byte_bpe_50k") -> DataFrame:
    """The token pieces of every whole text: its ids and the end id, cut at ``capacity``.

    Columns: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``. A null or empty text
    is the end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokenizer(file)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = tokens.encode_to_numpy(text.as_py(), allowed_special="all")
                ids = np.append(ids, END_ID).astype("<u4")
                at = 0
                for k, n in enumerate(piece_lengths(len(ids), capacity)):
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(ids[at : at + n].tobytes()))
                    at += n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return whole_texts(docs, "doc_id").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


# ---- one group --------------------------------------------------------------------------------


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of every item, largest items first, each into the fullest bin that has room; fills.

    Bins of one fill are alike, so a bit set of the fills in use finds the bin.
    """
    order = np.argsort(-sizes, kind="stable")
    where = np.empty(len(sizes), np.int64)
    fills: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    in_use = 0
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        below = in_use & ((1 << (capacity - size + 1)) - 1)
        if below:
            fill = below.bit_length() - 1
            which = open_bins[fill].pop()
            if not open_bins[fill]:
                in_use ^= 1 << fill
        else:
            fill, which = 0, len(fills)
            fills.append(0)
        where[i] = which
        fill += size
        fills[which] = fill
        if fill < capacity:
            open_bins[fill].append(which)
            in_use |= 1 << fill
    return where, np.array(fills, np.int64)


def handed_on(fills: np.ndarray, capacity: int, smallest: int, partners: int) -> np.ndarray:
    """The bins that later rounds may still fill.

    ``smallest`` is the size of the smallest item there is: a bin with less room is done. A
    merge joins two bins of which one is at most half full, so of the fuller ones the emptiest
    ``partners`` suffice.
    """
    room = capacity - fills >= smallest
    small = room & (2 * fills <= capacity)
    large = np.flatnonzero(room & ~small)
    keep = small.copy()
    keep[large[np.argsort(fills[large], kind="stable")[:partners]]] = True
    return keep


# ---- rounds -----------------------------------------------------------------------------------


def _round(items: DataFrame, level: int, capacity: int, smallest: int, partners: int) -> DataFrame:
    """Pack the items of every group: the bin of each, and which bins are handed on."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("item", kind="stable")  # the same bins in whatever order rows come
        where, fills = best_fit(group["size"].to_numpy(np.int64), capacity)
        keep = handed_on(fills, capacity, smallest, partners)
        return pd.DataFrame(
            {
                "item": group["item"].to_numpy(),
                "bin": (key[0] << _ID_BITS) + where,
                "fill": fills[where],
                "open": keep[where],
            }
        )

    grouped = items.select("item", "size", "group").groupBy("group")
    return grouped.applyInPandas(pack, "item long, bin long, fill long, open boolean")


def packed(docs: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Pack the token pieces of all documents into sequences of at most ``capacity`` tokens.

    Columns: those of ``pieces`` with ``sequence_id`` and ``offset``. Offsets of a sequence are
    gapless from 0. Null and empty texts are pieces of one token, repeated rows are packed each,
    null ids like others, an empty table gives no rows, further columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    table = stored(
        pieces(docs, capacity).withColumn("item", F.monotonically_increasing_id())
    )
    whole = table.where(F.col("length") == capacity)
    rest = table.where(F.col("length") < capacity)
    total, smallest = rest.agg(F.count("*"), F.min("length")).first()
    groups = max(1, math.ceil(total / group_items))
    levels = max(0, math.ceil(math.log(groups, FAN_IN) - 1e-9))
    items = rest.select(
        "item", F.col("length").alias("size"), F.pmod(F.xxhash64("item"), F.lit(groups)).alias("group")
    )
    rounds = []
    for level in range(levels + 1):
        partners = FAN_IN * (levels - level)
        done = stored(_round(items, level, capacity, smallest or 1, partners))
        rounds.append(done)
        items = (
            done.where("open")
            .groupBy("bin")
            .agg(F.max("fill").alias("size"))
            .select(
                F.col("bin").alias("item"),
                "size",
                F.floor(F.shiftright("bin", _ID_BITS) / FAN_IN).cast("long").alias("group"),
            )
        )
    # A bin of a later round takes the place of the bins that went into it, from the last round on.
    bins = None
    for level in range(levels, -1, -1):
        done = rounds[level].select(
            "item", F.col("bin").alias("old"), (F.col("bin") * (levels + 1) + level).alias("own")
        )
        if bins is None:
            bins = done.select("item", F.col("own").alias("sequence_id"))
        else:
            later = bins.select(F.col("item").alias("old"), "sequence_id")
            bins = done.join(later, "old", "left").select(
                "item", F.coalesce("sequence_id", "own").alias("sequence_id")
            )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    sequences = rest.join(bins, "item").select(*columns, "sequence_id", "item")
    # Sequences hold at most ``capacity`` pieces, so this window has bounded groups.
    before = F.sum("length").over(_within())
    placed = sequences.select(*columns, "sequence_id", (before - F.col("length")).alias("offset"))
    alone = whole.select(
        *columns, (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return placed.unionByName(alone)


def _within():
    from pyspark.sql import Window

    order = Window.partitionBy("sequence_id").orderBy("item")
    return order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
