"""Near duplicates by SimHash, compared at the anchors of a covering code.

The anchors are the words of a product of Hamming codes: the fingerprint is cut into blocks of seven
bits, and in every block each value is within one bit of exactly one code word. So the covering
radius is one bit a block, and the word nearest in all blocks is the home of a fingerprint. Two
fingerprints that differ in few bits reach each other's home: it is within the covering radius plus
the threshold, that is, the bits by which blocks are farther from it than one add up to the
threshold at most. Every fingerprint is replicated to all such anchors that do not come before its
home, and what meets at an anchor is compared. Two fingerprints meet at the later of their homes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.common import BLANKS, prepare, stored, text_bytes, whole_texts
from rosterlens.llm.components import components

WORDS = 3
SEED = 42
#: Fingerprints link at so many differing bits or fewer.
THRESHOLD = 2
#: An anchor at which more fingerprints meet leaves them to a join of changed fingerprints.
CROWD = 1 << 17
#: Texts are read so many bytes at a time, and as many rows are compared at a time.
TEXT_BLOCK = 1 << 20
ROWS = 1 << 16

BITS = 64
_BLOCK = 7
_BLOCKS = BITS // _BLOCK
_DATA = 4


# ---- fingerprints -----------------------------------------------------------------------------


def _word_lists(raw: np.ndarray) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; every list begins with the last two words before it."""
    low, before = 0, []
    while low < len(raw):
        high = min(low + TEXT_BLOCK, len(raw))
        while high < len(raw) and raw[high] not in BLANKS:
            high += 1
        found = before + raw[low:high].tobytes().lower().split()
        yield found
        low, before = high, found[-(WORDS - 1) :]


def fingerprint(raw: np.ndarray) -> int:
    """The SimHash of a text in UTF-8; 0 without words."""
    total, counts, found = 0, np.zeros(BITS, np.int64), []
    for found in _word_lists(raw):
        hashes = np.array(
            [xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in zip(*(found[i:] for i in range(WORDS)))],
            np.dtype("<u8"),
        )
        total += len(hashes)
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    if total == 0:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED) if found else 0
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint``, a long with the 64 bits, of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, at = text_bytes(batch.column("text"))
            found = np.array([fingerprint(buf[a:b]) for a, b in zip(at[:-1], at[1:])], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    return whole_texts(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, fingerprint long")


# ---- anchors ----------------------------------------------------------------------------------


def _hamming() -> tuple[np.ndarray, list[np.ndarray]]:
    """Of every block value the number of its home word, and the words it reaches at a cost.

    A word reached at cost c is c bits farther than the radius; lists are filled up with -1.
    """
    values = np.arange(1 << _BLOCK)
    bits = (values[:, None] >> np.arange(_BLOCK)) & 1
    syndrome = np.bitwise_xor.reduce(bits * np.arange(1, _BLOCK + 1), axis=1)
    words = values[syndrome == 0]
    distance = np.bitwise_count(values[:, None] ^ words)
    home = distance.argmin(1)
    reached = []
    for cost in range(1, _BLOCK):
        near = [np.flatnonzero(row == 1 + cost) for row in distance]
        table = np.full((len(values), max(len(n) for n in near)), -1)
        for value, found in enumerate(near):
            table[value, : len(found)] = found
        reached.append(table)
    return home, reached


_HOME, _REACHED = _hamming()


def _blocks(values: np.ndarray) -> list[np.ndarray]:
    return [(values >> np.uint64(_BLOCK * b)).astype(np.int64) & ((1 << _BLOCK) - 1) for b in range(_BLOCKS)]


def homes(values: np.ndarray) -> np.ndarray:
    """The anchor within the covering radius of every fingerprint; the last bit is free."""
    parts = [_HOME[part] << (_DATA * b) for b, part in enumerate(_blocks(values))]
    return np.bitwise_or.reduce(parts)


def reach(values: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Position and anchor of all anchors within the radius plus the threshold of the fingerprints.

    Each anchor comes once: blocks are gone through in order, and one that takes a farther word
    than its home pays for it out of the threshold.
    """
    home = homes(values)
    owner, anchor = np.arange(len(values)), home
    left = np.full(len(values), threshold)
    for b, part in enumerate(_blocks(values)):
        more = [(owner, anchor, left)]
        for cost in range(1, threshold + 1):
            able = np.flatnonzero(left >= cost)
            words = _REACHED[cost - 1][part[owner[able]]]
            row, column = np.nonzero(words >= 0)
            at = able[row]
            change = words[row, column] ^ _HOME[part[owner[at]]]
            more.append((owner[at], anchor[at] ^ (change << (_DATA * b)), left[at] - cost))
        owner, anchor, left = (np.concatenate(p) for p in zip(*more))
    return owner, anchor


def _replicated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("fingerprint").to_numpy().view(np.uint64)
        home = homes(values)
        owner, anchor = reach(values)
        later = anchor >= home[owner]
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor[later]), pa.array(values[owner[later]].view(np.int64))], ["anchor", "fingerprint"]
        )


# ---- comparison -------------------------------------------------------------------------------


def _forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest position that links join with each of n positions, going on from labels."""
    label = np.arange(n) if label is None else label
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(anchor: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is similar among rows in order of their anchor; a forest, no circles."""
    n = len(anchor)
    run_end = np.searchsorted(anchor, anchor, side="right")
    at, label = np.arange(n), np.arange(n)
    a, b, waiting = [], [], 0
    shift = 1
    while len(at):
        at = at[at + shift < run_end[at]]
        near = at[np.bitwise_count(values[at] ^ values[at + shift]) <= THRESHOLD]
        a.append(near)
        b.append(near + shift)
        waiting += len(near)
        shift += 1
        if waiting > ROWS or not len(at):
            label = _forest(n, np.concatenate(a), np.concatenate(b), label)
            a, b, waiting = [], [], 0
    joined = np.flatnonzero(label != np.arange(n))
    return values[joined], values[label[joined]]


def _pairs(u: np.ndarray, v: np.ndarray | None) -> pa.RecordBatch:
    other = pa.array(v.view(np.int64)) if v is not None else pa.nulls(len(u), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), other], ["u", "v"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the fingerprints that meet; those of a crowd come without a partner.

    Rows come in order of their anchor. They are compared when an anchor is complete; at most
    CROWD rows of one anchor are held.
    """
    held, n, crowd = [], 0, None

    def taken(keep_last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, n
        anchor = np.concatenate([h[0] for h in held])
        values = np.concatenate([h[1] for h in held])
        cut = int(np.searchsorted(anchor, anchor[-1])) if keep_last else len(anchor)
        if cut:
            yield _pairs(*_links(anchor[:cut], values[:cut]))
        held, n = [(anchor[cut:], values[cut:])], len(anchor) - cut

    for batch in batches:
        anchor = batch.column("anchor").to_numpy()
        values = batch.column("fingerprint").to_numpy().view(np.uint64)
        if crowd is not None:
            more = int(np.searchsorted(anchor, crowd, side="right"))
            yield _pairs(values[:more], None)
            anchor, values = anchor[more:], values[more:]
            crowd = crowd if not len(anchor) else None
        if not len(anchor):
            continue
        held.append((anchor, values))
        n += len(anchor)
        if n >= ROWS:
            yield from taken(keep_last=True)
            if n > CROWD:
                crowd = int(held[0][0][0])
                yield _pairs(held[0][1], None)
                held, n = [], 0
    if n:
        yield from taken(keep_last=False)


def _changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every fingerprint under all values that differ from it in at most THRESHOLD bits."""
    changes = [np.zeros(1, np.uint64)]
    for _ in range(THRESHOLD):
        changes.append(np.unique(changes[-1][:, None] ^ (np.uint64(1) << np.arange(BITS, dtype=np.uint64))))
    change = np.unique(np.concatenate(changes[1:]))
    for batch in batches:
        for value in batch.column("u").to_numpy().view(np.uint64):
            yield _pairs(value ^ change, np.full(len(change), value))


def links(found: DataFrame) -> DataFrame:
    """Links ``u, v`` that join the distinct ``fingerprint`` values that differ in few bits.

    Every two that do are joined by the links, directly or through others. One fingerprint is
    some 150 rows of 16 bytes in the shuffle. A crowd, an anchor with more than CROWD
    fingerprints, is not compared at its anchor: its fingerprints are looked up under each change
    of their bits, by a join that has no frequent keys.
    """
    met = (
        found.select("fingerprint")
        .mapInArrow(_replicated, "anchor long, fingerprint long")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_compared, "u long, v long")
    )
    met = stored(met.where("v is null or u != v"))
    crowd = met.where("v is null").select("u").distinct()
    changed = crowd.mapInArrow(_changed, "u long, v long")
    return met.where("v is not null").unionByName(changed.join(crowd, "u").where("u < v"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document its SimHash and the component of near duplicates it is in.

    Columns: ``doc_id``, ``fingerprint`` (16 lower-case hex digits), ``component_id``, the
    smallest ``doc_id`` that links of fingerprints reach. A null text has no words, so its
    fingerprint is zero, which links like any other. Equal fingerprints are one node, so copies
    and repeated rows are in one component whatever their number. Null ids are rows of their own
    and never the smallest; a component of nulls only has a null id. An empty table gives no
    rows; further columns are ignored. A text is read in blocks: a task holds its longest text
    once, and some dozen bytes for each byte of TEXT_BLOCK.
    """
    rows = stored(fingerprints(docs))
    nodes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes))
    linked = nodes.join(roots, nodes["fingerprint"] == roots["node"]).select("fingerprint", "least", "root")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    # Compared as structs, so both sides are exchanged and a root with many fingerprints is split.
    smallest = smallest.select(F.struct("root").alias("key"), "component_id")
    labels = linked.join(smallest, F.struct(linked["root"]) == smallest["key"]).select("fingerprint", "component_id")
    alone = nodes.join(labels, "fingerprint", "left_anti").select("fingerprint", F.col("least").alias("component_id"))
    labels = labels.unionByName(alone).withColumnRenamed("fingerprint", "node")
    return rows.join(labels, rows["fingerprint"] == labels["node"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
