"""Exact dedup by polynomial fingerprints that compose.

Every chunk of a text is hashed by itself. Two neighbours combine by shifting the first by the
length of the second, so the chunks of a huge document may be hashed anywhere and in any order.
Documents with equal fingerprints are then compared chunk by chunk: within a group, the smallest
and the largest text of every chunk must be equal. Both are aggregates that combine before the
shuffle, so a group of any size stays a few rows per task.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from rosterlens.llm.common import prepare, stored, text_bytes, whole_texts

CHUNK_BYTES = 1 << 16
COMPARED_CHARACTERS = 1 << 15
#: Two primes below 2**31 and a base for each.
MODULI = ((2147483647, 1103515245), (2147483629, 1540483477))
_EXPLODED = 10_000
#: Bits of the table that tells which keys need a look; what is sent of it has at most this size.
KEY_BITS = 1 << 25


def _base_powers(base: int, prime: int, n: int) -> np.ndarray:
    """base**(n - 1), ..., base, 1 modulo the prime, by doubling."""
    table = np.ones(1, np.uint64)
    while len(table) < n:
        step = np.uint64(pow(base, len(table), prime))
        table = np.concatenate([table, table * step % np.uint64(prime)])
    return table[:n][::-1].copy()


_POWERS = [_base_powers(base, prime, CHUNK_BYTES) for prime, base in MODULI]


def chunk_hash(chunk: np.ndarray) -> tuple[int, ...]:
    """The hashes of at most CHUNK_BYTES bytes, and their number."""
    wide = chunk.astype(np.uint64) + np.uint64(1)
    n = len(chunk)
    hashes = [
        int(np.dot(wide, table[CHUNK_BYTES - n :])) % prime
        for table, (prime, _) in zip(_POWERS, MODULI)
    ]
    return (*hashes, n)


def combine(first: tuple[int, ...], second: tuple[int, ...]) -> tuple[int, ...]:
    """The hashes of two neighbouring stretches as one."""
    n = second[-1]
    shifted = [
        (h * pow(base, n, prime) + g) % prime
        for h, g, (prime, base) in zip(first, second, MODULI)
    ]
    return (*shifted, first[-1] + n)


def text_hash(buf: np.ndarray) -> tuple[int, ...]:
    """The hashes of a whole text, from its chunks."""
    found = (0,) * len(MODULI) + (0,)
    for low in range(0, len(buf), CHUNK_BYTES):
        found = combine(found, chunk_hash(buf[low : low + CHUNK_BYTES]))
    return found


def packed(found: tuple[int, ...]) -> int:
    return found[0] << 31 | found[1]


@F.arrow_udf(LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    buf, at = text_bytes(texts)
    return pa.array([packed(text_hash(buf[a:b])) for a, b in zip(at[:-1], at[1:])], pa.int64())


def combine_chunks(chunks: DataFrame, document: str, position: str, chunk: str) -> DataFrame:
    """Fingerprints of documents that are stored as rows of chunks.

    Chunk hashes are computed where the rows are; only 28 bytes a chunk are shuffled, and they
    are combined in order of position. ``n_bytes`` is the length in UTF-8.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, at = text_bytes(batch.column("chunk"))
            found = [text_hash(buf[a:b]) for a, b in zip(at[:-1], at[1:])]
            parts = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("document"), batch.column("position"), *parts],
                ["document", "position", "h0", "h1", "n"],
            )

    prepare(chunks.sparkSession)
    kinds = dict(chunks.dtypes)
    source = chunks.select(
        F.col(document).alias("document"), F.col(position).alias("position"), F.col(chunk).alias("chunk")
    )
    schema = f"document {kinds[document]}, position {kinds[position]}, h0 long, h1 long, n long"
    rows = source.mapInArrow(hashed, schema)

    @F.arrow_udf("struct<fingerprint: long, n_bytes: long>")
    def folded(parts: pa.Array) -> pa.Array:
        out = []
        for row in parts.to_pylist():
            found = (0, 0, 0)
            for p in row:
                found = combine(found, (p["h0"], p["h1"], p["n"]))
            out.append({"fingerprint": packed(found), "n_bytes": found[-1]})
        return pa.array(out, pa.struct([("fingerprint", pa.int64()), ("n_bytes", pa.int64())]))

    per_document = rows.groupBy("document").agg(
        F.array_sort(F.collect_list(F.struct("position", "h0", "h1", "n"))).alias("parts")
    )
    return per_document.select("document", folded("parts").alias("f")).select("document", "f.*")


def _fingerprints(texts: DataFrame, *columns: str) -> DataFrame:
    return texts.select(
        *columns,
        fingerprint("text").alias("fingerprint"),
        F.octet_length("text").cast("long").alias("n_bytes"),
    )


def _slot(*columns: str | Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(KEY_BITS)).cast("int")


def _marked(keys: DataFrame, *columns: str) -> Callable[..., Column]:
    """A condition that holds for all rows with one of the keys, and for few others.

    It needs no exchange of the rows: the keys are marked in a table of KEY_BITS bits, which is
    combined in the tasks and sent to all of them. The more keys there are, the more other rows it
    lets through.
    """
    spark = keys.sparkSession
    bits = np.zeros(KEY_BITS // 64, np.uint64)
    bit = F.expr("shiftleft(1L, slot % 64)")
    words = keys.select(_slot(*columns).alias("slot")).groupBy(F.expr("slot div 64").alias("word"))
    words = words.agg(F.bit_or(bit).alias("bits")).toPandas()
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    sent, table = spark.sparkContext.broadcast(zlib.compress(bits.tobytes(), 1)), []

    @F.arrow_udf("boolean")
    def holds(slots: pa.Array) -> pa.Array:
        if not table:
            table.append(np.frombuffer(zlib.decompress(sent.value), np.uint64))
        slot = slots.to_numpy()
        return pa.array(table[0][slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1) == 1)

    return lambda *found: holds(_slot(*found))


def _unequal(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """Fingerprints whose documents differ in some chunk."""
    same = ["fingerprint", "n_bytes"]
    alike = _marked(shared, *same)
    copies = _fingerprints(texts, "text").where(alike(*same)).join(shared, same, "left_semi")
    size = F.lit(COMPARED_CHARACTERS)
    chunk = F.explode(F.sequence(F.lit(0), F.floor(F.char_length("text") / size).cast("int")))
    chunks = copies.select(*same, "text", chunk.alias("chunk")).select(
        *same, "chunk", F.col("text").substr(F.col("chunk") * size + 1, size).alias("part")
    )
    compared = chunks.groupBy(*same, "chunk").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    return compared.where(F.col("low") != F.col("high")).select(*same).distinct()


def duplicates(docs: DataFrame) -> DataFrame:
    """Per document the one that stays of those with an equal text.

    Columns: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. Of equal texts
    the row with the largest ``doc_id`` stays. A null text counts as empty. Repeated rows are
    rows of their own, of which one stays. A null ``doc_id`` stays only if its group has no
    other; then ``keep_id`` is null. An empty table gives no rows; further columns are ignored.
    """
    prepare(docs.sparkSession)
    texts = whole_texts(docs, "doc_id")
    same = ["fingerprint", "n_bytes"]
    rows = stored(
        _fingerprints(texts, "doc_id", F.sha2("text", 256).alias("text_sha256"))
        .groupBy("doc_id", *same, "text_sha256")
        .agg(F.count("*").alias("copies"))
    )
    shared = rows.groupBy(*same).agg(F.sum("copies").alias("n")).where("n > 1").select(*same)
    unequal = _unequal(texts, shared).withColumn("unequal", F.lit(True))
    # Where one fingerprint stands for several texts, their digests tell them apart.
    kind = F.when(F.col("unequal"), F.col("text_sha256")).otherwise("").alias("kind")
    split = rows.join(unequal, same, "left").select("doc_id", *same, "text_sha256", "copies", kind)
    group = [*same, "kind"]
    groups = split.groupBy(*group).agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    found = split.join(groups, group)
    # Repeated rows are counted above and come back here, in stretches of bounded length.
    stretch = F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / _EXPLODED).cast("long"))
    )
    found = found.withColumn("stretch", stretch)
    left = F.col("copies") - F.col("stretch") * _EXPLODED
    found = found.withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(left, F.lit(_EXPLODED).cast("long"))))
    )
    first = (F.col("stretch") == 0) & (F.col("copy") == 1)
    return found.select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without the copies that ``duplicates`` drops, all columns as they were.

    Of repeated rows that differ in other columns only, the smallest row stays. A null text is
    equal to an empty one; of equal texts a null ``doc_id`` stays only where there is no other. An
    empty table gives no rows; columns of any name are kept. Rows that stay and are alone with
    their id and text are not exchanged; only the others are, each once. A text is hashed by one
    task, which holds it once.
    """
    prepare(docs.sparkSession)
    key = ["doc_id", "text_sha256"]
    decided = duplicates(docs).groupBy(*key).agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    decided = stored(decided.where("n > 1 or not kept"))
    doubtful = _marked(decided, *key)
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("row_id"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("digest"),
    ).withColumn("doubtful", doubtful("row_id", "digest"))
    found = rows.where("doubtful").join(
        decided, F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("digest") == F.col("text_sha256")), "left"
    )
    # Marked by chance only, or one of the rows of a kept id and text.
    found = found.where(F.col("n").isNull() | F.col("kept"))
    repeated = found.where("n is not null")
    order = Window.partitionBy("row_id", "digest").orderBy(F.to_json("row"))
    repeated = repeated.withColumn("nth", F.row_number().over(order)).where("nth = 1")
    alone = rows.where("not doubtful").select("row").unionByName(found.where("n is null").select("row"))
    return alone.unionByName(repeated.select("row")).select("row.*")
