"""Removal of passages that occur more than once, by super-k-mers of words.

The minimiser of a window of words is its smallest run of four words. Consecutive windows with one
minimiser travel together, as one packed string, to the bucket of that minimiser, so all equal
windows meet there; the bucket cuts the strings into windows again and sorts them.

Runs that very many windows have as minimiser come last in the order, so that a window uses one
only if it has no other. Such windows lie within passages that are repeated a lot. They are
compared where they are read: of equal ones a slice of texts marks all and sends one on, to a
bucket of the window itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.common import (
    WORD,
    mix,
    prepare,
    rows_of,
    span_hashes,
    spans,
    text_bytes,
    text_slices,
    whole_texts,
    word_hashes,
)

WINDOW = 35
RUN = 4
BUCKET_BYTES = 1 << 22
SLICE = 1 << 22
#: Minimisers of at least so many super-k-mers come last; at most so many of them.
FREQUENT_LEAST = 4096
FREQUENT = 1 << 16
_COUNTED = 1 << 19
_LOCAL_LEAST = 8
_LAST = np.uint64(1 << 63)
_ORIGIN = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("word", "<i4")])


# ---- windows ----------------------------------------------------------------------------------


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    out, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        out = np.minimum(out[:-step], out[step:])
        covered += step
    return out


class Words:
    """The words of a slice of texts, and the minimiser of every window."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, frequent: np.ndarray | None = None):
        self.buf = buf
        self.start, self.end = spans(WORD[buf], offsets)
        self.row = rows_of(self.start, offsets)
        n = len(self.start)
        self.first = np.searchsorted(self.row, np.arange(len(offsets)))
        hashes = word_hashes(buf, self.start, self.end)
        at = np.arange(max(0, n - RUN + 1))
        runs = span_hashes(hashes, at, at + RUN) & ~_LAST
        if frequent is not None and len(frequent):
            place = np.searchsorted(frequent, runs)
            place[place == len(frequent)] = 0
            runs |= np.where(frequent[place] == runs, _LAST, np.uint64(0))
        self.minimiser = sliding_min(runs, WINDOW - RUN + 1)
        count = len(self.minimiser)
        self.inside = self.row[:count] == self.row[WINDOW - 1 : WINDOW - 1 + count]

    def super_kmers(self) -> tuple[np.ndarray, np.ndarray]:
        """First window and the one after the last of every run of windows with one minimiser."""
        low = self.minimiser
        new = self.inside.copy()
        new[1:] &= ~self.inside[:-1] | (low[1:] != low[:-1]) | (self.row[1 : len(low)] != self.row[: len(low) - 1])
        begin = np.flatnonzero(new)
        stop = np.flatnonzero(self.inside & np.r_[new[1:] | ~self.inside[1:], True]) + 1 if len(low) else begin
        return begin, stop


def exact_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Numbers that are equal exactly for words of equal bytes."""
    hashes = word_hashes(buf, start, end)
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    size = end - start
    other = start[first][number]
    if np.array_equal(size, (end - start)[first][number]):
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        if np.array_equal(buf[at + np.repeat(start, size)], buf[at + np.repeat(other, size)]):
            return number
    known: dict[bytes, int] = {}
    raw = buf.tobytes()
    return np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(start, end)], np.int64)


def repeated(number: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows that start at these words: which have an equal, and which come first of equals.

    Windows are sorted by a hash of their words' numbers; neighbours are then compared word by
    word. Windows that share a hash without being equal are sorted by their words.
    """
    values = mix(number.astype(np.uint64) + np.uint64(1))
    hashes = span_hashes(values, at, at + WINDOW)
    order = np.argsort(hashes, kind="stable")
    same = np.zeros(len(order), bool)
    close = np.flatnonzero(hashes[order][1:] == hashes[order][:-1]) + 1
    one, two = at[order[close - 1]], at[order[close]]
    equal = np.ones(len(close), bool)
    for k in range(WINDOW):
        equal &= number[one + k] == number[two + k]
    if not equal.all():
        columns = [number[at + k] for k in range(WINDOW)]
        order = np.lexsort(columns[::-1])
        sorted_ = np.stack([c[order] for c in columns])
        same[1:] = (sorted_[:, 1:] == sorted_[:, :-1]).all(axis=0)
    else:
        same[close] = True
    again = same.copy()
    again[:-1] |= same[1:]
    out, leads = np.zeros(len(order), bool), np.zeros(len(order), bool)
    out[order] = again
    leads[order] = ~same
    return out, leads


def ranges(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive numbers in a sorted array: the first, and the one after the last."""
    if not len(marked):
        return marked, marked
    new = np.flatnonzero(np.r_[True, np.diff(marked) > 1])
    return marked[new], marked[np.r_[new[1:] - 1, len(marked) - 1]] + 1


# ---- counting minimisers ----------------------------------------------------------------------


def _size_and_frequent(texts: DataFrame) -> tuple[int, np.ndarray]:
    """The size of all texts in bytes, and the minimisers that come last, sorted.

    Super-k-mers are counted over all texts, in stretches of bounded size; a stretch reports the
    minimisers it has several times. At most FREQUENT minimisers reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def counted() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            held.clear()
            often = n >= _LOCAL_LEAST
            columns = [pa.array(value[often].astype(np.int64)), pa.array(n[often])]
            return pa.RecordBatch.from_arrays(columns, ["minimiser", "n"])

        for batch in batches:
            for _, _, buf, offsets in text_slices(batch.column(0), SLICE):
                words = Words(buf, offsets)
                held.append(words.minimiser[words.super_kmers()[0]])
                total += len(buf)
                if sum(map(len, held)) >= _COUNTED:
                    yield counted()
        yield counted()
        columns = [pa.array([-1], pa.int64()), pa.array([total], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["minimiser", "n"])

    counts = texts.select("text").mapInArrow(count, "minimiser long, n long")
    counts = counts.groupBy("minimiser").agg(F.sum("n").alias("n"))
    often = (F.col("n") >= FREQUENT_LEAST) | (F.col("minimiser") == -1)
    order = [F.col("minimiser") != -1, F.desc("n"), "minimiser"]
    rows = counts.where(often).orderBy(*order).limit(FREQUENT + 1).collect()
    size = next((r["n"] for r in rows if r["minimiser"] == -1), 0)
    frequent = [r["minimiser"] for r in rows if r["minimiser"] != -1]
    return size, np.sort(np.array(frequent, np.int64).astype(np.uint64))


# ---- sending ----------------------------------------------------------------------------------


def _packed(parts: list[bytes], origin: np.ndarray) -> tuple[bytes, bytes]:
    strings = pa.compress(b"\n".join(parts), codec="zstd", asbytes=True)
    return len(b"\n".join(parts)).to_bytes(8, "little") + strings, origin.tobytes()


def _send(texts: DataFrame, frequent: np.ndarray, buckets: int) -> DataFrame:
    """Packed super-k-mers by bucket, and ranges that are known to be repeated.

    ``strings`` has the words of each super-k-mer, ``origins`` its text and first word;
    ``found`` has ranges of words, as text, first word and word after the last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.array(batch.column(k)) for k in (0, 1)]
            for low, high, buf, offsets in text_slices(batch.column(2), SLICE):
                words = Words(buf, offsets, frequent)
                begin, stop = words.super_kmers()
                hot = words.minimiser[begin] >= _LAST
                found, alone = _local(words, begin[hot], stop[hot])
                bucket = np.concatenate([mix(words.minimiser[begin[~hot]]), alone[1]]) % np.uint64(buckets)
                begin, stop = np.r_[begin[~hot], alone[0]], np.r_[stop[~hot], alone[0] + 1]
                row = words.row[begin] if len(begin) else np.zeros(0, np.int64)
                origin = np.empty(len(begin), _ORIGIN)
                origin["k1"], origin["k2"] = keys[0][low:high][row], keys[1][low:high][row]
                origin["word"] = begin - words.first[row]
                # Words are joined by one blank, whatever separates them in the text.
                solid = WORD[buf]
                keep = solid.copy()
                keep[1:] |= solid[:-1]
                raw = np.where(solid, buf, 32)[keep].astype(np.uint8).tobytes()
                place = np.cumsum(keep) - 1
                first = place[words.start[begin]].tolist() if len(begin) else []
                last = (place[words.end[stop + WINDOW - 2] - 1] + 1).tolist() if len(begin) else []
                order = np.argsort(bucket, kind="stable")
                bounds = np.flatnonzero(np.r_[True, np.diff(bucket[order].astype(np.int64)) != 0, True])
                out = {"bucket": [], "strings": [], "origins": [], "found": []}
                for a, b in zip(bounds[:-1], bounds[1:]) if len(order) else ():
                    mine = order[a:b]
                    strings, origins = _packed([raw[first[i] : last[i]] for i in mine.tolist()], origin[mine])
                    out["bucket"].append(int(bucket[mine[0]]))
                    out["strings"].append(strings)
                    out["origins"].append(origins)
                    out["found"].append(None)
                if len(found[0]):
                    row = words.row[found[0]]
                    marks = np.empty((len(row), 4), "<i8")
                    marks[:, 0], marks[:, 1] = keys[0][low:high][row], keys[1][low:high][row]
                    marks[:, 2], marks[:, 3] = found[0] - words.first[row], found[1] - words.first[row]
                    out["bucket"].append(int(mix(np.array([marks[0, 0]]).astype(np.uint64))[0] % np.uint64(buckets)))
                    out["strings"].append(None)
                    out["origins"].append(None)
                    out["found"].append(marks.tobytes())
                columns = [pa.array(out["bucket"], pa.int32())]
                columns += [pa.array(out[k], pa.binary()) for k in ("strings", "origins", "found")]
                yield pa.RecordBatch.from_arrays(columns, list(out))

    return texts.mapInArrow(run, "bucket int, strings binary, origins binary, found binary")


def _local(words: Words, begin: np.ndarray, stop: np.ndarray):
    """Windows of a slice that lie within often repeated passages.

    Returns ranges of words of those with an equal in the slice, and of each kind the first
    window with a hash of its words, by which it is sent on.
    """
    none = np.zeros(0, np.int64)
    if not len(begin):
        return (none, none), (none, np.zeros(0, np.uint64))
    size = stop - begin
    at = np.repeat(begin, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    number = exact_words(words.buf, words.start, words.end)
    again, leads = repeated(number, at)
    lead = at[leads]
    hashes = word_hashes(words.buf, words.start, words.end)
    low, high = ranges(at[again])
    # Windows of neighbouring texts may follow each other in number.
    low, high = _split_rows(words, low, high)
    return (low, high + WINDOW - 1), (lead, span_hashes(hashes, lead, lead + WINDOW))


def _split_rows(words: Words, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of windows cut where the text changes."""
    if not len(low) or np.array_equal(words.row[low], words.row[high - 1]):
        return low, high
    at = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
    new = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (np.diff(words.row[at]) != 0)])
    return at[new], at[np.r_[new[1:] - 1, len(at) - 1]] + 1


# ---- buckets ----------------------------------------------------------------------------------

_FOUND = "k1 long, k2 long, low int, high int"


def _found(k1, k2, low, high) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(k1)), pa.array(np.ascontiguousarray(k2))]
    columns += [pa.array(np.asarray(x).astype(np.int32)) for x in (low, high)]
    return pa.RecordBatch.from_arrays(columns, ["k1", "k2", "low", "high"])


def _count(sent: DataFrame) -> DataFrame:
    """Ranges of words that windows with an equal cover."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, origins = [], []
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for strings, origin, marks in zip(column["strings"], column["origins"], column["found"]):
                if marks.is_valid:
                    m = np.frombuffer(marks.as_py(), "<i8").reshape(-1, 4)
                    yield _found(m[:, 0], m[:, 1], m[:, 2], m[:, 3])
                if strings.is_valid:
                    data = strings.as_py()
                    size = int.from_bytes(data[:8], "little")
                    parts.append(pa.decompress(data[8:], size, codec="zstd", asbytes=True))
                    origins.append(np.frombuffer(origin.as_py(), _ORIGIN))
        if not parts:
            return
        buf = np.frombuffer(b"\n".join(parts), np.uint8)
        parts.clear()
        origin = np.concatenate(origins)
        offsets = np.concatenate([[0], np.flatnonzero(buf == 10) + 1, [len(buf)]])
        start, end = spans(WORD[buf], offsets)
        first = np.searchsorted(start, offsets)
        number = exact_words(buf, start, end)
        windows = np.diff(first) - WINDOW + 1
        owner = np.repeat(np.arange(len(windows)), windows)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        again, _ = repeated(number, first[:-1][owner] + nth)
        hit = np.flatnonzero(again)
        if len(hit):
            new = np.flatnonzero(np.r_[True, (np.diff(hit) > 1) | (np.diff(owner[hit]) != 0)])
            low, high = hit[new], hit[np.r_[new[1:] - 1, len(hit) - 1]]
            mine = origin[owner[low]]
            yield _found(
                mine["k1"], mine["k2"], mine["word"] + nth[low], mine["word"] + nth[high] + WINDOW
            )

    return sent.groupBy("bucket").applyInArrow(run, _FOUND)


# ---- on documents -----------------------------------------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a 128-bit key of id and text. Equal rows share it and have one result."""
    return whole_texts(docs, "doc_id").select(
        F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", "doc_id").alias("k2"), "doc_id", "text"
    )


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """``k1, k2, low, high``: ranges of words that repeated windows cover, for the keys of rows."""
    prepare(docs.sparkSession)
    texts = _keyed(docs)
    size, frequent = _size_and_frequent(texts)
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    return _count(_send(texts.select("k1", "k2", "text"), frequent, buckets)).distinct()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every text without the words that a repeated window of WINDOW words covers.

    Columns: ``doc_id, n_words, n_removed, kept``: the kept words joined by one blank. A window
    is repeated if its words also start anywhere else, in the same text or another; windows are
    judged on the input. A null or empty text has no words. Repeated rows count as texts of their
    own and so lose all their windows; a text shorter than a window loses none. An empty table
    gives no rows; further columns are ignored.
    """
    found = repeated_ranges(docs)
    lists = found.groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    rows = _keyed(docs).join(lists, ["k1", "k2"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, buf, offsets in text_slices(batch.column(1)):
                start, end = spans(WORD[buf], offsets)
                first = np.searchsorted(start, offsets)
                raw = buf.tobytes()
                kept, removed = [], []
                for i, marks in enumerate(batch.column(2)[low:high]):
                    a, b = int(first[i]), int(first[i + 1])
                    stay = np.ones(b - a, bool)
                    if marks.is_valid:
                        values = marks.values
                        for x, y in zip(values.field("low").to_pylist(), values.field("high").to_pylist()):
                            stay[x:y] = False
                    pick = np.flatnonzero(stay) + a
                    kept.append(b" ".join([raw[x:y] for x, y in zip(start[pick].tolist(), end[pick].tolist())]))
                    removed.append(b - a - len(pick))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high],
                        pa.array(np.diff(first)),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept string"
    return rows.select("doc_id", "text", "ranges").mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """The result of ``remove_repeats`` with a digest in place of the kept words."""
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
