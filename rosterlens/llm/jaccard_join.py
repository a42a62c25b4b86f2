"""Near duplicates by a blocked sparse product of documents by n-grams.

Documents with the same set of shingles are one row of the matrix. Its columns are shingles in
one global order, the most frequent ones last; rows that are similar enough share a shingle among
the first quarter, so only these entries are multiplied. The entries are dealt to column blocks;
a block multiplies its columns with each other and gives pairs. An entry has its place in its row
and the column before it: a pair is given where its rows come from different columns, which holds
at the first column they share, and if what is left of both rows from there on can reach the bound
for their sizes, which holds there for all similar rows. So near copies, which share most of their
columns, are not given once per block.

Frequent columns are not multiplied out, for that would be the square of a group of copies. A row
that has one among its first entries has all its other shingles there too, which are multiplied.
So beyond the pairs of the product two such rows share frequent shingles only, and whether they
are similar depends on the sets of these and on their sizes: rows that agree in both are one group.
Groups are compared with a leader first, the one that has the least besides frequent shingles and
so is nearest to what the others are copies of, then where they are not in one component yet. The same holds for candidates of the product: each row is compared with its
smallest partner, then with those outside its component.

Before two sets are compared, their signatures are: 1024 bits, of which every shingle sets one. A
bit that one set has and the other lacks is a shingle they do not share, so the bits bound the
overlap from above and no link is lost. Whole texts are sent only for the pairs that are left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.llm.common import mix, prepare, shingles, stored, text_bytes, text_slices, whole_texts
from rosterlens.llm.components import components
from rosterlens.llm.exact_dedup import _marked as marked

WORDS = 5
#: Similar: 100 * intersection >= PERCENT * union.
PERCENT = 75
SHORT = 32
BLOCK_ENTRIES = 500_000
#: Copies within a slice send their entries once.
ENTRY_SLICE = 1 << 20
#: Shingles that come last in the order, at most so many; the order changes no result.
FREQUENT = 1 << 17
FREQUENT_LEAST = 24
_COUNTED = 1 << 22
#: 64-bit words of a signature.
SIGNATURE = 16
_PAIRS = 1 << 20
#: A column is the first 48 bits of a hash; shingles that share them are one column.
_COLUMN = np.uint64(16)
_ENTRY = np.dtype(
    [("low", "<u4"), ("high", "<u2"), ("prev_low", "<u4"), ("prev_high", "<u2"), ("place", "<u2"), ("n", "<i4"), ("cls", "<i8")]
)
_CARRIERS = 64


# ---- sets -------------------------------------------------------------------------------------


def _lower(buf: np.ndarray) -> np.ndarray:
    out = buf.copy()
    out[(buf >= 65) & (buf <= 90)] += 32
    return out


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within it, and the n + 1 bounds of the texts."""
    found, row, _ = shingles(_lower(buf), offsets, WORDS)
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    found, row = found[new], row[new]
    return found, np.searchsorted(row, np.arange(len(offsets)))


def set_keys(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit key of every set; 0 for the empty one."""
    total = np.zeros(len(found) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(mix(found ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
        keys = total[bounds[1:]] - total[bounds[:-1]]
    size = np.diff(bounds)
    keys = mix(keys ^ mix(size.astype(np.uint64)))
    return np.where(size > 0, keys, 0).astype(np.int64)


def signatures(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The signature of every set, sets by words."""
    rows = len(bounds) - 1
    bits = np.zeros((rows, 64 * SIGNATURE), bool)
    bits[np.repeat(np.arange(rows), np.diff(bounds)), (mix(found) % np.uint64(64 * SIGNATURE)).astype(np.int64)] = True
    return np.packbits(bits, axis=1).view("<i8")


def _summaries(texts: DataFrame) -> DataFrame:
    """Per row its set's size, key and signature; and per stretch of rows how many sets have a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()

        def counted() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            often = n > 1
            held.clear()
            seen.clear()
            return _summary(None, None, None, None, value[often].astype(np.int64), n[often])

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for low, high, buf, offsets in text_slices(batch.column(2)):
                found, bounds = shingle_sets(buf, offsets)
                keys = set_keys(found, bounds)
                for i, key in enumerate(keys.tolist()):
                    if key and key not in seen:
                        seen.add(key)
                        held.append(found[bounds[i] : bounds[i + 1]])
                ids = [batch.column(k)[low:high] for k in (0, 1)]
                yield _summary(ids, np.diff(bounds), keys, signatures(found, bounds), None, None)
                if sum(map(len, held)) >= _COUNTED:
                    yield _typed(counted(), kind)
        if kind is not None:
            yield _typed(counted(), kind)

    kind = texts.schema["doc_id"].dataType.simpleString()
    rows = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(
        run, f"doc_id {kind}, text_hash long, n int, cls long, bits array<long>, h long, sets int"
    )


def _summary(ids, n, cls, bits, h, sets) -> pa.RecordBatch:
    length = len(h) if ids is None else len(ids[0])

    def column(values, kind):
        return pa.nulls(length, kind) if values is None else pa.array(values, kind)

    ids = ids or [pa.nulls(length), pa.nulls(length, pa.int64())]
    if bits is not None:
        bits = list(bits)
    rest = [
        column(n, pa.int32()), column(cls, pa.int64()), column(bits, pa.list_(pa.int64())),
        column(h, pa.int64()), column(sets, pa.int32()),
    ]
    names = ["doc_id", "text_hash", "n", "cls", "bits", "h", "sets"]
    return pa.RecordBatch.from_arrays([*ids, *rest], names)


def _typed(batch: pa.RecordBatch, kind: pa.DataType) -> pa.RecordBatch:
    ids = pa.nulls(batch.num_rows, kind)
    return pa.RecordBatch.from_arrays([ids, *batch.columns[1:]], batch.schema.names)


def frequent_shingles(summaries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, at most FREQUENT, sorted, and the place of each by frequency."""
    counts = summaries.where("h IS NOT NULL").groupBy("h").agg(F.sum("sets").alias("sets"))
    top = counts.where(F.col("sets") >= FREQUENT_LEAST).orderBy(F.desc("sets"), "h").limit(FREQUENT)
    hashes = np.array([r[0] for r in top.select("h").collect()], np.int64).astype(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], (len(hashes) - order).astype(np.int64)


# ---- the product ------------------------------------------------------------------------------


def prefix(found: np.ndarray, bounds: np.ndarray, frequent: np.ndarray, places: np.ndarray):
    """The first entries of every row in the global order: entry numbers, and which are frequent.

    The order is by hash; the frequent shingles come after all others, by frequency. A row of n entries needs
    n - ceil(n * PERCENT / 100) + 1 of them.
    """
    size = np.diff(bounds)
    last = np.zeros(len(found), np.int64)
    if len(frequent):
        at = np.searchsorted(frequent, found)
        at[at == len(frequent)] = 0
        last = np.where(frequent[at] == found, places[at], 0)
    row = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((found, last, row))
    place = np.arange(len(found)) - np.repeat(bounds[:-1], size)
    need = size - (size * PERCENT + 99) // 100 + 1
    picked = order[place < need[row]]
    return picked, last[picked] > 0, row[picked]


def _entries(texts: DataFrame, frequent: np.ndarray, places: np.ndarray, blocks: int) -> DataFrame:
    """Matrix entries dealt to column blocks, packed: ``block, entries``.

    A row with frequent shingles among its first entries is a row of its own too, with a block
    below zero: its class, the key of its frequent shingles, its size, their number, and those
    among its first entries.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, offsets in text_slices(batch.column(0), ENTRY_SLICE):
                found, bounds = shingle_sets(buf, offsets)
                keys = set_keys(found, bounds)
                picked, last, row = prefix(found, bounds, frequent, places)
                _, unique = np.unique(keys, return_index=True)
                once = np.isin(row, unique[keys[unique] != 0])
                picked, last, row = picked[once], last[once], row[once]
                size = np.diff(bounds)
                rare = np.bincount(row[~last], minlength=len(keys))
                yield _carriers(found, bounds, frequent, keys, rare, picked[last], row[last])
                picked, row = picked[~last], row[~last]
                column, place, prev, picked, row = _chained(found, picked, row)
                entries = np.empty(len(picked), _ENTRY)
                entries["low"], entries["high"] = _halves(column)
                entries["prev_low"], entries["prev_high"] = _halves(prev)
                entries["place"], entries["n"], entries["cls"] = np.minimum(place, 65535), size[row], keys[row]
                block = (mix(column) % np.uint64(blocks)).astype(np.int32)
                order = np.argsort(block, kind="stable")
                entries, block = entries[order], block[order]
                which, first = np.unique(block, return_index=True)
                parts = [x.tobytes() for x in np.split(entries, first[1:])] if len(which) else []
                rest = [pa.nulls(len(which), f.type) for f in _SENT_TYPES[2:]]
                columns = [pa.array(which, pa.int32()), pa.array(parts, pa.binary()), *rest]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in _SENT_TYPES])

    return texts.select("text").mapInArrow(run, _SENT)


def _halves(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (column & np.uint64(0xFFFFFFFF)).astype(np.uint32), (column >> np.uint64(32)).astype(np.uint16)


def _whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)


def _chained(found: np.ndarray, picked: np.ndarray, row: np.ndarray):
    """Column, place and column before of every entry, and the entries: of a row's entries in one column the first."""
    column = found[picked] >> _COLUMN
    begins = np.ones(len(row), bool)
    begins[1:] = row[1:] != row[:-1]
    first = np.flatnonzero(begins)
    place = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
    new = begins.copy()
    new[1:] |= column[1:] != column[:-1]
    column, place, picked, row = column[new], place[new], picked[new], row[new]
    prev = np.zeros(len(column), np.uint64)
    prev[1:] = column[:-1]
    prev[place == 0] = 0
    return column, place, prev, picked, row


_SENT = "block int, entries binary, cls long, frequent long, n int, rest int, hashes binary"
_SENT_TYPES = [
    pa.field("block", pa.int32()), pa.field("entries", pa.binary()), pa.field("cls", pa.int64()),
    pa.field("frequent", pa.int64()), pa.field("n", pa.int32()), pa.field("rest", pa.int32()),
    pa.field("hashes", pa.binary()),
]


def _carriers(found, bounds, frequent, keys, rare, picked, row) -> pa.RecordBatch:
    """The rows that have frequent shingles among their first entries."""
    rows, first = np.unique(row, return_index=True)
    size = np.diff(bounds)
    hashes, mine = [], []
    for x in np.split(found[picked], first[1:]) if len(rows) else []:
        hashes.append(x.tobytes())
    for r in rows.tolist():
        own = found[bounds[r] : bounds[r + 1]]
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        mine.append(own[frequent[at] == own])
    ends = np.concatenate([[0], np.cumsum([len(x) for x in mine])]).astype(np.int64)
    sets = set_keys(np.concatenate(mine) if mine else np.zeros(0, np.uint64), ends)
    block = -1 - (mix(keys[rows].astype(np.uint64)) % np.uint64(_CARRIERS)).astype(np.int64)
    columns = [
        pa.array(block.astype(np.int32)), pa.nulls(len(rows), pa.binary()), pa.array(keys[rows]), pa.array(sets),
        pa.array(size[rows].astype(np.int32)), pa.array((size - rare)[rows].astype(np.int32)),
        pa.array(hashes, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.name for f in _SENT_TYPES])


_PRODUCT = "a long, b long, n_a int, n_b int, rest int, hashes binary"
_PRODUCT_NAMES = ["a", "b", "n_a", "n_b", "rest", "hashes"]


def _multiply(entries: np.ndarray) -> Iterator[pa.Table]:
    """The pairs of one block that may be similar; entries of long columns as they are.

    Rows with ``n_b`` are pairs. Rows without are entries: ``a`` the column, ``b`` the row.
    """
    h = _whole(entries["low"], entries["high"])
    order = np.lexsort((entries["cls"], h))
    entries, h = entries[order], h[order]
    new = np.ones(len(entries), bool)
    new[1:] = (h[1:] != h[:-1]) | (entries["cls"][1:] != entries["cls"][:-1])
    entries, h = entries[new], h[new]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    length = np.diff(np.r_[first, len(h)])
    each = np.repeat(length, length)
    yield _long(entries[each > SHORT], h[each > SHORT])
    short = (each > 1) & (each <= SHORT)
    entries, h = entries[short], h[short]
    # A stretch ends at the end of a column, so a stretch is a small product of its own.
    bounds = np.flatnonzero(np.r_[True, h[1:] != h[:-1], True]) if len(h) else np.zeros(1, np.int64)
    low = 0
    while low < len(bounds) - 1:
        high = int(np.searchsorted(bounds, bounds[low] + _PAIRS // SHORT, side="right")) - 1
        high = max(high, low + 1)
        yield _products(entries[bounds[low] : bounds[high]], h[bounds[low] : bounds[high]])
        low = high


def _products(e: np.ndarray, h: np.ndarray) -> pa.Table:
    left, right = [], []
    prev, size = _whole(e["prev_low"], e["prev_high"]), e["n"].astype(np.int64)
    remains, begins = size - e["place"], e["place"] == 0
    for step in range(1, SHORT):
        i = np.flatnonzero(h[step:] == h[:-step])
        if not len(i):
            break
        j = i + step
        # Rows that come from one column were met there, or that column is long.
        may = (prev[i] != prev[j]) | begins[i] | begins[j]
        may &= 100 * np.minimum(size[i], size[j]) >= PERCENT * np.maximum(size[i], size[j])
        may &= (100 + PERCENT) * np.minimum(remains[i], remains[j]) >= PERCENT * (size[i] + size[j])
        left.append(i[may])
        right.append(j[may])
    i = np.concatenate(left) if left else np.zeros(0, np.int64)
    j = np.concatenate(right) if right else np.zeros(0, np.int64)
    order = np.lexsort((e["cls"][j], e["cls"][i]))
    i, j = i[order], j[order]
    a, b = e["cls"][i], e["cls"][j]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
    i, j = i[new], j[new]
    none = [pa.nulls(len(i), pa.int32()), pa.nulls(len(i), pa.binary())]
    return pa.table([*(pa.array(x) for x in (e["cls"][i], e["cls"][j], e["n"][i], e["n"][j])), *none], _PRODUCT_NAMES)


def _long(e: np.ndarray, h: np.ndarray) -> pa.Table:
    none = pa.nulls(len(e), pa.int32())
    return pa.table(
        [pa.array(h.astype(np.int64)), pa.array(e["cls"]), pa.array(e["n"]), none, none, pa.nulls(len(e), pa.binary())],
        _PRODUCT_NAMES,
    )


def _product(entries: DataFrame) -> DataFrame:
    """Pairs, entries of long columns, and rows with frequent shingles, which have ``hashes``."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            if key[0].as_py() >= 0:
                buf, _ = text_bytes(column["entries"])
                held.append(np.frombuffer(buf.tobytes(), _ENTRY))
            else:
                none = pa.nulls(batch.num_rows, pa.int32())
                columns = [column[k] for k in ("cls", "frequent", "n")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, none, column["rest"], column["hashes"]], _PRODUCT_NAMES
                )
        if held:
            for table in _multiply(np.concatenate(held)):
                yield from table.to_batches()

    return entries.groupBy("block").applyInArrow(run, _PRODUCT)


# ---- comparison -------------------------------------------------------------------------------


def _texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """A text of each of the needed classes, and of few others: ``cls, text``, one row a class.

    A text is some third of the size of its set and is compressed on its way, so texts are sent
    and their sets are made where they are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, buf, offsets in text_slices(batch.column(0)):
                keys = set_keys(*shingle_sets(buf, offsets))
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0)[low:high]], ["cls", "text"])

    wanted = marked(needed, "doc_id", "text_hash")
    texts = whole_texts(docs, F.col("doc_id").alias("rep")).withColumn("rep_hash", F.xxhash64("text"))
    # Texts that are not asked for stay where they are; repeated rows combine before they are sent.
    texts = texts.where(wanted("rep", "rep_hash")).select("text")
    return texts.mapInArrow(run, "cls long, text string").dropDuplicates(["cls"])


def similar(left: pa.Array, right: pa.Array, frequent: np.ndarray) -> np.ndarray:
    """Per pair of texts 0 if their sets are not similar, 2 if they are so by frequent shingles alone, else 1."""
    out = np.zeros(len(left), np.int32)
    for low, high, buf, offsets in text_slices(left):
        a, a_at = shingle_sets(buf, offsets)
        b, b_at = shingle_sets(*text_bytes(right[low:high]))
        for i in range(high - low):
            x, y = a[a_at[i] : a_at[i + 1]], b[b_at[i] : b_at[i + 1]]
            shared = np.intersect1d(x, y, assume_unique=True)
            both, often = len(x) + len(y), 0
            if (100 + PERCENT) * len(shared) < PERCENT * both:
                continue
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, shared), len(frequent) - 1)
                often = int((frequent[at] == shared).sum())
            out[low + i] = 2 if (100 + PERCENT) * often >= PERCENT * both else 1
    return out


def _verified(pairs: DataFrame, texts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """The pairs of classes ``a, b`` that are similar, and whether by frequent shingles alone."""

    def compare(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array(similar(left, right, frequent))

    first = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(first, "a").join(second, "b")
    found = joined.select("a", "b", F.arrow_udf(compare, "int")("text_a", "text_b").alias("how"))
    return found.where("how > 0").select("a", "b", (F.col("how") == 2).alias("frequent"))


def _near(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose signatures allow them to be similar."""

    def lacks(x: str, y: str):
        words = (F.get(x, F.lit(i)).bitwiseAND(F.bitwise_not(F.get(y, F.lit(i)))) for i in range(SIGNATURE))
        return reduce(add, map(F.bit_count, words))

    first, second = (
        signed.select(F.col("cls").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}"))
        for k in ("a", "b")
    )
    most = F.least(F.col("n_a") - lacks("bits_a", "bits_b"), F.col("n_b") - lacks("bits_b", "bits_a"))
    reach = (100 + PERCENT) * most >= PERCENT * (F.col("n_a") + F.col("n_b"))
    return pairs.select("a", "b").join(first, "a").join(second, "b").where(reach).select("a", "b")


def _fits(x: str, y: str):
    """Whether sets of these sizes can be similar."""
    small, large = F.least(x, y), F.greatest(x, y)
    return small * 100 >= large * PERCENT


def _bucket(n):
    return F.floor(F.log(n) / math.log(100 / PERCENT)).cast("int")


def _pair(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _may(n_a: str, n_b: str, rest_a: str, rest_b: str):
    """Whether rows that share at most the smaller rest can be similar."""
    shared = F.least(rest_a, rest_b)
    return _fits(n_a, n_b) & ((100 + PERCENT) * shared >= PERCENT * (F.col(n_a) + F.col(n_b)))


def _reach():
    """Whether sizes from ``low`` to ``high`` on both sides allow similar sets that share at most ``most``."""
    fits = (F.col("high") * 100 >= F.col("low_b") * PERCENT) & (F.col("high_b") * 100 >= F.col("low") * PERCENT)
    return fits & ((100 + PERCENT) * F.least("most", "most_b") >= PERCENT * (F.col("low") + F.col("low_b")))


def _leader_pairs(entries: DataFrame) -> DataFrame:
    """Every row of a column with the column's leader of its size and of the next size up.

    The leader is the row that has the least besides frequent shingles.
    """
    sized = entries.withColumn("bucket", _bucket(F.col("n")))
    leader = F.min_by(F.struct("cls", "n", "rest"), F.struct(-F.col("rest") / F.col("n"), "cls")).alias("leader")
    leaders = sized.groupBy("h", "bucket").agg(leader).select(
        "h", "bucket", F.col("leader.cls").alias("b"), F.col("leader.n").alias("n_b"), F.col("leader.rest").alias("rest_b")
    )
    near = sized.withColumn("bucket", F.explode(F.array("bucket", F.col("bucket") + 1)))
    pairs = near.join(leaders, ["h", "bucket"]).where(_may("n", "n_b", "rest", "rest_b") & (F.col("cls") != F.col("b")))
    return pairs.select(*_pair("cls", "b")).distinct()


def _across(entries: DataFrame) -> DataFrame:
    """Pairs of rows that share a column and are not in one component yet.

    Rows with the same columns, component and size meet as one, then their rows. At the first column
    that two kinds share, what they can share is no more than either has from there on; kinds for
    which that is too little at a column do not meet there, nor those that come from one column.
    Most rows of a column are in one component; the others meet all, so copies do not meet each other.
    """
    sized = entries.withColumn("bucket", _bucket(F.col("n")))
    spans = sized.groupBy("h", "kind", "root", "bucket").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("rest") - F.col("place")).alias("most"),
        F.first("before").alias("before"),
    )
    sizes = spans.groupBy("h", "root").agg(F.count("*").alias("size"))
    main = sizes.groupBy("h").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("roots"))
    spans = stored(spans.join(main.where("roots > 1").drop("roots"), "h"))
    others = spans.drop("main").select("h", *(F.col(c).alias(f"{c}_b") for c in spans.columns if c not in ("h", "main")))
    once = (F.col("root_b") == F.col("main")) | (F.struct("kind", "root") < F.struct("kind_b", "root_b"))
    begins = F.col("before").isNull() | F.col("before_b").isNull() | (F.col("before") != F.col("before_b"))
    apart = (F.col("root") != F.col("root_b")) & F.abs(F.col("bucket") - F.col("bucket_b")).isin(0, 1)
    both = spans.where("root != main").join(others, "h").where(apart & begins & once & _reach())
    both = both.select("kind", "root", "bucket", "kind_b", "root_b", "bucket_b").distinct()
    placed = sized.select("kind", "cls", "n", "rest", "root", "bucket").distinct()
    members = placed.select(*(F.col(c).alias(f"{c}_b") for c in placed.columns))
    pairs = both.join(placed, ["kind", "root", "bucket"]).join(members, ["kind_b", "root_b", "bucket_b"])
    pairs = pairs.where(_may("n", "n_b", "rest", "rest_b") & (F.col("cls") != F.col("cls_b")))
    return pairs.select(*_pair("cls", "cls_b")).distinct()


# ---- on documents -----------------------------------------------------------------------------


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows ``doc_id, text_hash, n, cls``, and ``cls, root`` of every class with a shingle."""
    prepare(docs.sparkSession)
    texts = whole_texts(docs, "doc_id")
    summaries = stored(_summaries(texts))
    rows = summaries.where("n IS NOT NULL").select("doc_id", "text_hash", "n", "cls")
    classes = rows.where("n > 0").groupBy("cls").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
    classes = classes.select("cls", "one.*")
    links = _links(texts, summaries, classes)
    roots = stored(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    placed = classes.select("cls").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    return rows, placed.select("cls", F.coalesce("root", "cls").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document the smallest id it reaches by links of near duplicates.

    Columns: ``doc_id, n_shingles, component_id``. Two documents link if the Jaccard similarity
    of their sets of five lower-cased words is at least PERCENT / 100. A text with fewer words
    has its whole sequence as its one shingle; a null or empty text, or one of blanks, has none
    and links with nothing: its component is its own id. Repeated rows are rows of their own,
    alike. A null id is passed over where the component has another. An empty table gives no
    rows; further columns are ignored.
    """
    rows, placed = _placed(docs)
    smallest = (
        rows.groupBy("cls").agg(F.min("doc_id").alias("doc_id")).join(placed, "cls")
        .groupBy("root").agg(F.min("doc_id").alias("component_id"))
    )
    of_class = placed.join(smallest, "root").select("cls", "component_id")
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles")]
    known = rows.where("n > 0").join(of_class, "cls").select(*columns, "component_id")
    alone = rows.where("n = 0").select(*columns, F.col("doc_id").alias("component_id"))
    return known.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, that with its smallest ``doc_id``; all columns as they were.

    Rows without a shingle all stay. Of repeated rows that differ in other columns only, the
    smallest stays. A null ``doc_id`` stays only where its component has no other. An empty table gives
    no rows; columns of any name are kept. Rows that stay and do not repeat are not exchanged.
    """
    rows, placed = _placed(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = F.min_by(F.struct("doc_id", "text_hash"), order).alias("first")
    of_class = rows.where("n > 0").groupBy("cls").agg(first).select("cls", "first.*")
    stay = of_class.join(placed, "cls").groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("stays"), F.col("first.text_hash").alias("text_hash"), F.lit(1).alias("most")
    )
    bare = rows.where("n = 0").select(F.col("doc_id").alias("stays"), "text_hash").distinct()
    stay = stay.unionByName(bare.withColumn("most", F.lit(None).cast("int"))).withColumn("kept", F.lit(True))
    keys = rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"))
    here = F.col("doc_id").eqNullSafe(F.col("stays")) & (keys["text_hash"] == stay["text_hash"])
    decided = keys.join(stay, here, "left").select(
        "doc_id",
        keys["text_hash"],
        F.coalesce("kept", F.lit(False)).alias("kept"),
        (F.col("rows") > F.col("most")).alias("repeated"),
    )
    decided = stored(decided.where("repeated or not kept"))
    doubtful = marked(decided, "doc_id", "text_hash")
    found = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("row_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("row_hash"),
    ).withColumn("doubtful", doubtful("row_id", "row_hash"))
    same = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_hash") == F.col("text_hash"))
    # Marked by chance only, or one of the repeated rows of a kept id and text.
    judged = found.where("doubtful").join(decided, same, "left").where("kept is null or kept")
    order = Window.partitionBy("row_id", "row_hash").orderBy(F.to_json("row"))
    one = judged.where("kept").withColumn("nth", F.row_number().over(order)).where("nth = 1")
    alone = found.where("not doubtful").select("row").unionByName(judged.where("kept is null").select("row"))
    return alone.unionByName(one.select("row")).select("row.*")


def _links(texts: DataFrame, summaries: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``a, b`` between classes, as many as it takes to join what is similar."""
    frequent, places = frequent_shingles(summaries)
    total = summaries.where("n > 0").agg(F.sum(F.col("n") / 4 + 1)).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_ENTRIES))
    product = stored(_product(_entries(texts, frequent, places, blocks)))
    entry = "n_b IS NULL AND hashes IS NULL"
    long = product.where(entry).select(F.col("a").alias("h"), F.col("b").alias("cls"), F.col("n_a").alias("n"))
    carriers = product.where("hashes IS NOT NULL").select(
        F.col("a").alias("cls"), F.col("b").alias("frequent"), F.col("n_a").alias("n"), "rest", "hashes"
    ).dropDuplicates(["cls"])
    # Rows with the same frequent shingles and size stand and fall together.
    groups = stored(
        carriers.groupBy("frequent", "n").agg(F.min_by(F.struct("cls", "rest", "hashes"), "cls").alias("head"))
        .select("frequent", "n", "head.*")
    )
    heads = groups.select("frequent", "n", F.col("cls").alias("head"))
    members = stored(carriers.join(heads, ["frequent", "n"]).where("cls != head").select("cls", "head", "n", "rest"))
    alike = members.where((100 + PERCENT) * F.col("rest") >= 2 * PERCENT * F.col("n"))
    alike = alike.select(*_pair("cls", "head"))
    # What rows of long columns share is not known: up to all.
    entries = stored(
        _spread(groups).unionByName(
            long.select(
                "h", F.lit(0).alias("place"), F.lit(None).cast("long").alias("before"), F.col("cls").alias("kind"),
                "cls", "n", F.col("n").alias("rest"),
            )
        )
    )
    signed = stored(summaries.where("n > 0").select("cls", "n", "bits").dropDuplicates(["cls"]))

    def verified(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
        return _verified(pairs, _texts_of(texts, stored(ends.join(classes, "cls"))), frequent)

    counted = stored(_near(product.where("n_b IS NOT NULL").select("a", "b").distinct(), signed))
    partner = counted.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    tried = stored(partner.unionByName(_near(_leader_pairs(entries), signed)).distinct())
    links = stored(_widened(stored(verified(tried)), members).unionByName(alike))
    roots = stored(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    more = stored(
        _outside(counted, roots).unionByName(_near(_across(_rooted(entries, _settled(roots, members))), signed))
        .distinct().join(tried, ["a", "b"], "left_anti")
    )
    if more.isEmpty():
        return links
    return links.unionByName(stored(_widened(stored(verified(more)), members)))


def _rooted(entries: DataFrame, roots: DataFrame) -> DataFrame:
    return stored(entries.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")))


def _spread(groups: DataFrame) -> DataFrame:
    """The columns of the groups' heads: ``h, place, before, kind, cls, n, rest``; equal sets of columns are one kind.

    ``place`` counts the head's frequent shingles that come before, ``before`` is the last of them.
    """

    @F.arrow_udf("array<long>")
    def unpacked(hashes: pa.Array) -> pa.Array:
        buf, at = text_bytes(hashes)
        values = pa.array(np.frombuffer(buf.tobytes(), "<i8"))
        return pa.LargeListArray.from_arrays(pa.array(at // 8), values).cast(pa.list_(pa.int64()))

    rows = groups.select(unpacked("hashes").alias("columns"), F.xxhash64("hashes").alias("kind"), "cls", "n", "rest")
    rows = rows.select(F.posexplode("columns").alias("place", "h"), "columns", "kind", "cls", "n", "rest")
    before = F.get("columns", F.col("place") - 1).alias("before")
    return rows.select("h", "place", before, "kind", "cls", "n", "rest")


def _widened(verified: DataFrame, members: DataFrame) -> DataFrame:
    """Links of heads by frequent shingles alone hold for all members of their groups."""
    own = members.select("cls", "head")
    by = verified.where("frequent").select("a", "b")
    first = by.join(own, by["a"] == own["head"]).select(*_pair("cls", "b"))
    second = by.join(own, by["b"] == own["head"]).select(*_pair("cls", "a"))
    return verified.select("a", "b").unionByName(first).unionByName(second).distinct()


def _settled(roots: DataFrame, members: DataFrame) -> DataFrame:
    """``cls, root`` of heads; those whose members are not all with them count as apart from all."""
    named = roots.withColumnRenamed("node", "cls")
    own = members.select("cls", "head").join(named, "cls", "left")
    own = own.select("head", F.coalesce("root", "cls").alias("member_root"))
    heads = own.join(named.withColumnRenamed("cls", "head"), "head", "left")
    loose = heads.where(~F.col("member_root").eqNullSafe(F.coalesce("root", "head")))
    loose = loose.select(F.col("head").alias("cls")).distinct()
    apart = loose.select("cls", F.xxhash64("cls", F.lit(1)).alias("root"))
    return named.join(loose, "cls", "left_anti").unionByName(apart)


def _outside(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose rows are in different components."""
    left = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    right = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    placed = pairs.join(left, "a", "left").join(right, "b", "left")
    return placed.where(~F.coalesce("root_a", "a").eqNullSafe(F.coalesce("root_b", "b"))).select("a", "b")


