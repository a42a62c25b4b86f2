"""Phrase collocations by dynamic itemset counting.

The corpus is cut into shards that are scanned in a circle. A scan counts phrases of all lengths that
are active: words from the start, a longer phrase once both phrases that lack its first or last word
have reached the threshold in the scans so far. A phrase is counted in every shard once and is then
complete, wherever in the circle it began. Longer phrases so start while shorter ones are counted,
and the scans end when none is left.

The scan knows what is active from a table of a fixed number of slots: the slot of a phrase holds the
step since which the phrase had reached the threshold. Phrases that share a slot can only make others
active early. These are then counted for a full circle as well, so counts are exact.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.llm.common import (
    LOWER,
    byte_class,
    drop_stored,
    mix,
    prepare,
    rows_of,
    shared_folder,
    spans,
    text_bytes,
    text_slices,
    word_hashes,
)

#: More shards make longer phrases active sooner; fewer carry open counts on less often.
SHARDS = 2
#: Slots of the table of active phrases, of one byte each.
SLOTS = 1 << 24
SLICE_BYTES = 1 << 21

# Lengths, threshold and bounds of the report; what separates pieces and words.
MOST_WORDS, LEAST = 3, 10
CONTAINED_PERCENT = 50
TOP = 2000
NO_LANGUAGE = "und"
SCALE = 1_000_000
_BREAK = byte_class(b".,;:!?\n\x0b\x0c\r")
_WORD = byte_class(others=b".,;:!?\n\x0b\x0c\r \t")

_NEVER = 255
_STEP = np.uint64(0x9E3779B97F4A7C15)
_COUNTS = "lang string, phrase string, start int, n long"
_LENGTH = "CASE WHEN phrase = '' THEN 0 ELSE length(phrase) - length(replace(phrase, ' ', '')) + 1 END"


# ---- phrases of a slice -----------------------------------------------------------------------


def _within(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The positions of all ranges, one range after another; by steps, for they are many."""
    some = ends > starts
    starts, ends = starts[some], ends[some]
    step = np.ones(int((ends - starts).sum()), np.int32)
    if len(starts):
        at = np.cumsum(ends - starts)[:-1]
        step[0] = starts[0]
        step[at] = starts[1:] - ends[:-1] + 1
    return np.cumsum(step, dtype=np.int32)


def _joined(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words with one space after each, and where every word starts there."""
    length = ends - starts
    at = np.cumsum(length + 1) - (length + 1)
    out = np.append(buf, np.uint8(32))[_within(starts, ends + 1)]
    out[at + length] = 32
    return out, at


def _strings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ranges of a buffer as strings."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    data = buf[_within(starts, ends)]
    buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.string(), len(starts), buffers)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of every distinct hash, whichever, and how often it is there."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    return order[first], np.diff(np.r_[first, len(order)])


def _begun(seeds: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases of one word."""
    return mix(seeds ^ words)


def _longer(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    with np.errstate(over="ignore"):
        return mix(hashes * _STEP + words)


def _languages(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct languages of a batch, their hashes, and the number of each row's."""
    coded = column.dictionary_encode()
    digests = [hashlib.blake2b(name.encode(), digest_size=8).digest() for name in coded.dictionary.to_pylist()]
    return coded.dictionary, np.frombuffer(b"".join(digests), "<u8"), coded.indices.to_numpy().astype(np.int64)


def _parts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, lower-case bytes and offsets of slices; a long text is cut between its pieces."""
    for low, _, buf, offsets in text_slices(column, SLICE_BYTES, keep=True):
        if len(buf) <= 2 * SLICE_BYTES:
            yield low, LOWER[buf], offsets
            continue
        begin = 0
        while begin < len(buf):
            end = min(begin + SLICE_BYTES, len(buf))
            while end < len(buf):
                found = np.flatnonzero(_BREAK[buf[end : end + SLICE_BYTES]])
                end = end + int(found[0]) if len(found) else min(end + SLICE_BYTES, len(buf))
                if len(found):
                    break
            yield low, LOWER[buf[begin:end]], np.array([0, end - begin])
            begin = end


def _counted(
    buf: np.ndarray, offsets: np.ndarray, language: np.ndarray, seeds: np.ndarray, since: np.ndarray, step: int, shards: int, most_words: int
) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """Language, phrase, first step and count of the active phrases of a slice.

    The number of all words of a language comes as the phrase of no words.
    """
    starts, ends = spans(_WORD[buf], offsets)
    if not len(starts):
        return
    row = rows_of(starts, offsets)
    # A piece ends at a break or with its text.
    piece = np.cumsum(_BREAK[buf])[starts] + row
    words = word_hashes(buf, starts, ends)
    text, at = _joined(buf, starts, ends)
    mask = np.uint64(len(since) - 1)
    if step < shards:
        found, n = np.unique(language[row], return_counts=True)
        none = np.zeros(len(found), np.int64)
        yield found, _strings(text, none, none), none, n
    hashes, first = _begun(seeds[language[row]], words), np.zeros(len(starts), np.int64)
    for length in range(1, most_words + 1):
        if length > 1:
            whole = piece[: -(length - 1)] == piece[length - 1 :]
            reached = since[(hashes & mask).astype(np.int64)].astype(np.int64)
            first = np.where(whole, np.maximum(reached[:-1], reached[1:]), _NEVER)
            hashes = _longer(hashes[:-1], words[length - 1 :])
        active = np.flatnonzero((first <= step) & (step < first + shards))
        if len(active):
            index, n = _distinct(hashes[active])
            i = active[index]
            last = i + length - 1
            yield language[row[i]], _strings(text, at[i], at[last] + (ends - starts)[last]), first[i], n
        if len(hashes) < 2:
            return


def _scan(batches: Iterator[pa.RecordBatch], since: np.ndarray, step: int, shards: int, most_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, seeds, code = _languages(batch.column("lang"))
        for low, buf, offsets in _parts(batch.column("text")):
            own = code[low : low + len(offsets) - 1]
            for lang, phrases, first, n in _counted(buf, offsets, own, seeds, since, step, shards, most_words):
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(lang)), phrases, pa.array(first.astype(np.int32)), pa.array(n)],
                    ["lang", "phrase", "start", "n"],
                )


def _slots(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    """The slots of phrases as bits, 64 slots a row."""
    for batch in batches:
        _, seeds, code = _languages(batch.column("lang"))
        buf, offsets = text_bytes(batch.column("phrase"))
        starts, ends = spans(buf != 32, offsets)
        words = word_hashes(buf, starts, ends)
        size = np.bincount(rows_of(starts, offsets), minlength=len(code))
        first = np.cumsum(size) - size
        hashes = _begun(seeds[code], words[first])
        for k in range(1, size.max(initial=0)):
            more = np.flatnonzero(size > k)
            hashes[more] = _longer(hashes[more], words[first[more] + k])
        slot = hashes & np.uint64(slots - 1)
        word, at = np.unique(slot >> np.uint64(6), return_inverse=True)
        bits = np.zeros(len(word), np.uint64)
        np.bitwise_or.at(bits, at, np.uint64(1) << (slot & np.uint64(63)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"]
        )


# ---- scans in a circle ------------------------------------------------------------------------


def _written(table: DataFrame, *parts: str) -> DataFrame:
    spark = table.sparkSession
    path = shared_folder(spark)
    writer = table.write.option("compression", "zstd").partitionBy(*parts)
    # Hardly a phrase repeats, so a dictionary of them is built in vain.
    writer.option("parquet.enable.dictionary#phrase", "false").parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def _reached(counts: DataFrame, since: np.ndarray, step: int, most_words: int) -> np.ndarray:
    """The table of slots after a step; new entries may be used from the next step on.

    What reaches the driver is one bit a slot, combined before the shuffle.
    """
    frequent = counts.where("frequent").where(F.expr(_LENGTH).between(1, most_words - 1))

    n_slots = len(since)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _slots(batches, n_slots)

    found = frequent.select("lang", "phrase").mapInArrow(slots, "word long, bits long")
    words = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    if not len(words):
        return since
    bits = np.zeros(len(since) // 64, np.uint64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    new = np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool) & (since == _NEVER)
    return np.where(new, np.uint8(step + 1), since)


def count_phrases(
    docs: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST, shards: int = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """``lang, phrase, length, n`` of all phrases of at most ``most_words`` words found ``least`` times.

    Words are joined by one space. The phrase of length 0 has the number of all words of its
    language. ``slots`` is a power of two; fewer make more phrases active than need be and change
    no count. A language with most texts is many shards' rows; its phrases combine before the
    shuffle. There are at most ``shards * most_words`` steps, fewer than 255; each writes the
    phrases it completes and those it carries on. Memory: a slice takes some 100 bytes for each of
    SLICE_BYTES; a longer text is cut between its pieces, so a piece is held whole.
    """
    if shards * most_words >= _NEVER:
        raise ValueError("too many steps")
    spark = docs.sparkSession
    prepare(spark)
    corpus = _written(
        docs.select(
            F.coalesce(F.col("lang"), F.lit(NO_LANGUAGE)).alias("lang"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
            F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"),
        ),
        "shard",
    )
    since = np.full(slots, _NEVER, np.uint8)
    key = ["lang", "phrase"]
    steps: list[DataFrame] = []
    step, last = 0, shards
    while step < last:
        # Most slots are never taken, so the table is sent in a compressed form.
        shared = spark.sparkContext.broadcast(zlib.compress(since.tobytes(), 1))
        scan = _step(corpus.where(F.col("shard") == step % shards), shared, step, shards, most_words)
        if steps:
            scan = scan.unionByName(steps[-1].where("not complete").select(*key, "start", "n"))
        # A phrase begins where its parts have reached the threshold, in every slice alike.
        counts = scan.groupBy(*key).agg(F.min("start").alias("start"), F.sum("n").alias("n"))
        counts = counts.withColumns(
            {
                "complete": F.col("start") + shards <= step + 1,
                "frequent": (F.col("n") >= least) | (F.col("phrase") == ""),
            }
        )
        # Complete counts below the threshold are final and nothing asks for them; most are such.
        # Folders of their own, so the frequent ones are found without reading the others.
        steps.append(_written(counts.where("frequent or not complete"), "complete", "frequent"))
        shared.destroy()
        before, since = since, _reached(steps[-1], since, step, most_words)
        if (before != since).any():
            last = max(last, step + 1 + shards)
        step += 1
    drop_stored(corpus)
    found = steps[0].where("false")
    for table in steps:
        found = found.unionByName(table.where("complete and frequent"))
    return found.select("lang", "phrase", F.expr(_LENGTH).alias("length"), "n")


def _step(shard: DataFrame, shared: Broadcast[bytes], step: int, shards: int, most_words: int) -> DataFrame:
    """The counts of one scan, combined within slices only."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        since = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        yield from _scan(batches, since, step, shards, most_words)

    return shard.select("lang", "text").mapInArrow(scan, _COUNTS)


# ---- collocations -----------------------------------------------------------------------------


def _words(start: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, length), " ")


def _score() -> Column:
    """floor(SCALE * a * a / (l * r)) in decimals of 38 digits, for counts up to 10**16."""
    return F.expr(
        f"cast((cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * {SCALE}bd) "
        "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as bigint)"
    )


def collocations(
    docs: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST, top: int = TOP, shards: int = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """The best phrases of two to ``most_words`` words of every language.

    Columns: ``lang``, ``rank``, ``phrase``, ``a`` (its count), ``l`` and ``r`` (the counts of the
    parts of the cut with the lowest score), ``n`` (words of the language), ``score``. A null
    text has no words and a null ``lang`` is ``und``. Repeated rows count each time. Equal scores
    are ordered by count and phrase, so ranks are total. Languages without a phrase and empty
    tables give no rows; further columns are ignored.
    """
    found = count_phrases(docs, most_words, least, shards, slots)
    lengths, known = F.col("length"), found.select("lang", "phrase", "n")
    candidates = found.where("length > 1").select("lang", "phrase", "length", F.col("n").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), lengths - 1)))
    cuts = cuts.withColumns({"left": _words(F.lit(1), F.col("k")), "right": _words(F.col("k") + 1, lengths - F.col("k"))})
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    best = F.min(F.struct(_score().alias("score"), "k", "l", "r")).alias("best")
    scored = scored.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.*")
    # The longest candidate around a phrase, by count, decides whether it goes.
    spans_within = F.explode(F.sequence(F.lit(2), lengths - 1)).alias("size")
    around = candidates.where("length > 2").select("lang", "phrase", "length", "a", spans_within)
    around = around.withColumn("at", F.explode(F.sequence(F.lit(1), lengths - F.col("size") + 1)))
    around = around.select("lang", _words(F.col("at"), F.col("size")).alias("inner"), "a")
    around = around.groupBy("lang", "inner").agg(F.max("a").alias("longer"))
    around = around.select("lang", F.col("inner").alias("phrase"), "longer")
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < CONTAINED_PERCENT * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = found.where("length = 0").select("lang", F.col("n").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
