"""Nearest neighbours by cosine from shifted Hilbert orderings.

Unit vectors are projected on several random sets of directions, shifted and put in the order of
a Hilbert curve. Spark sorts all orderings by range; every vector then has a rank on each curve,
and a query meets what lies within a window of ranks of it on any curve. The candidates of all
curves are merged and ranked by the exact measure.

How wide the window has to be depends on the data: on vectors without structure neighbours are
far apart on every curve. So the width is read off a bounded sample of queries whose true
neighbours are found by comparing them with all vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.llm.common import prepare, stored

CURVES = 32
DIMENSIONS = 12
BITS = 4
LEAST_WINDOW = 64
BLOCK_ROWS = 2048
#: The sample that the scale of the curves is fitted to, and that of the window.
SCALE_SAMPLE = 2000
WINDOW_SAMPLE = 128
TARGET = 0.97
MARGIN = 1.2


# ---- curves -----------------------------------------------------------------------------------


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of points of small whole numbers; at most 63 bits in all.

    Axes are turned into the transposed index by undoing one level of rotations at a time, then
    Gray-decoded, and the bits of all axes are interleaved.
    """
    x = points.T.astype(np.int64)
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(axes):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(high, x[0] ^ below, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> level) & 1, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[i] >> level) & 1
    return key


class Curves:
    """Random directions, scales fitted to a sample, and a random shift for every curve."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, seed: int = 17):
        rng = np.random.default_rng(seed)
        width = sample.shape[1]
        axes = min(DIMENSIONS, width)
        self.sets = []
        for _ in range(curves):
            directions = np.linalg.qr(rng.normal(size=(width, width)))[0][:, :axes]
            placed = sample @ directions
            low, high = np.quantile(placed, [0.01, 0.99], axis=0)
            scale = 0.9 / np.maximum(high - low, 1e-12)
            self.sets.append((directions, low, scale, rng.random(axes) * 0.1))

    def keys(self, unit: np.ndarray) -> list[np.ndarray]:
        cells = 1 << BITS
        found = []
        for directions, low, scale, shift in self.sets:
            place = (unit @ directions - low) * scale + shift
            found.append(hilbert_keys(np.clip((place * cells).astype(np.int64), 0, cells - 1), BITS))
        return found


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of rows, each pair computed by itself, so that it is the same in every block."""
    norms = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    return (a * b).sum(axis=1) / norms


def nearest(queries: np.ndarray, rows: np.ndarray, heads: np.ndarray, k: int):
    """Of every query the k nearest rows: query number, row number, exact score.

    Of equal scores the row with the smaller head comes first.
    """
    close = (queries @ rows.T) / np.sqrt((rows * rows).sum(axis=1))
    close /= np.sqrt((queries * queries).sum(axis=1))[:, None]
    if len(heads) > k:
        # All rows that could be among the k: the product differs from the score in last digits.
        edge = np.partition(close, len(heads) - k, axis=1)[:, len(heads) - k] - 1e-9
        q, r = np.nonzero(close >= edge[:, None])
    else:
        q, r = np.nonzero(np.ones(close.shape, bool))
    score = cosine(queries[q], rows[r])
    order = np.lexsort((heads[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    nth = np.arange(len(q)) - np.searchsorted(q, q)
    return q[nth < k], r[nth < k], score[nth < k]


# ---- table ------------------------------------------------------------------------------------


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, v``: distinct rows with an id and a vector of the common length that has a direction."""
    rows = table.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
    rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (length[0]["n"] if length else 0))


def _ranked(classes: DataFrame, curves: Curves) -> DataFrame:
    """``curve, place, cls``: every class's rank on every curve, by one sort of all curves."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(1))
            if not len(rows):
                continue
            unit = rows / np.sqrt((rows * rows).sum(axis=1))[:, None]
            for curve, key in enumerate(curves.keys(unit)):
                columns = [pa.array(np.full(len(key), curve, np.int32)), pa.array(key), batch.column(0)]
                yield pa.RecordBatch.from_arrays(columns, ["curve", "key", "cls"])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            columns = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))]
            columns += [batch.column(0), batch.column(2)]
            at += n
            yield pa.RecordBatch.from_arrays(columns, ["part", "nth", "curve", "cls"])

    spark = classes.sparkSession
    ordered = (
        classes.select("cls", "v").mapInArrow(keys, "curve int, key long, cls long")
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "curve", "key", "cls")
        .sortWithinPartitions("curve", "key", "cls")
    )
    parts = stored(ordered.mapInArrow(numbered, "part int, nth long, curve int, cls long"))
    # One row per partition, not per vector.
    counts = {r["part"]: r["n"] for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect()}
    begin, total = {}, 0
    for part in sorted(counts):
        begin[part] = total
        total += counts[part]
    per_curve = total // len(curves.sets)
    offsets = spark.createDataFrame(list(begin.items()), "part int, begin long")
    place = F.col("begin") + F.col("nth") - F.col("curve") * F.lit(per_curve).cast("long")
    return parts.join(F.broadcast(offsets), "part").select("curve", place.alias("place"), "cls")


def _window(classes: DataFrame, queries: DataFrame, ranked: DataFrame, k: int) -> int:
    """The width that holds the target share of true neighbours of a sample of queries.

    The sample is compared with all vectors, batch by batch: linear in the table.
    """
    sample = queries.join(classes, "cls").orderBy(F.xxhash64("cls"), "cls").limit(WINDOW_SAMPLE).collect()
    if not sample:
        return LEAST_WINDOW
    asked = np.array([r["v"] for r in sample], np.float64)
    own = np.array([r["cls"] for r in sample], np.int64)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = matrix(batch.column(1)), np.array(batch.column(0))
            if len(ids):
                q, r, score = nearest(asked, rows, np.array(batch.column(2)), k + 1)
                columns = [pa.array(own[q]), pa.array(ids[r]), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["q", "cls", "score"])

    found = classes.mapInArrow(best, "q long, cls long, score double").where("q != cls")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "cls")
    true = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).select("q", "cls").collect()
    if not true:
        return LEAST_WINDOW
    wanted = sorted({x for r in true for x in (r["q"], r["cls"])})
    ids = classes.sparkSession.createDataFrame([(x,) for x in wanted], "cls long")
    places: dict[int, dict[int, int]] = {}
    for r in ranked.join(F.broadcast(ids), "cls").collect():
        places.setdefault(r["cls"], {})[r["curve"]] = r["place"]
    apart = [min(abs(places[r["q"]][c] - places[r["cls"]][c]) for c in places[r["q"]]) for r in true]
    return max(LEAST_WINDOW, math.ceil(MARGIN * float(np.quantile(apart, TARGET))))


def _candidates(classes: DataFrame, queries: DataFrame, ranked: DataFrame, window: int, k: int) -> DataFrame:
    """The k + 1 best classes of every query class in every block of ranks near it."""
    size = min(window, BLOCK_ROWS)
    reach = math.ceil(window / size)
    block = F.floor(F.col("place") / size).cast("long")
    placed = ranked.withColumn("block", block).join(classes, "cls")
    rows = placed.select("curve", "block", "cls", "v", "head", F.lit(False).alias("asks"))
    near = F.explode(F.sequence(F.greatest(F.lit(0), block - reach), block + reach))
    asking = ranked.join(queries, "cls").select("curve", near.alias("block"), "cls").join(classes, "cls")
    asking = asking.select("curve", "block", "cls", "v", "head", F.lit(True).alias("asks"))

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        asks = table["asks"].to_numpy()
        ids = table["cls"].to_numpy()
        if asks.all() or not asks.any():
            return
        vectors = matrix(table["v"].combine_chunks())
        heads = table["head"].to_numpy()[~asks]
        q, r, score = nearest(vectors[asks], vectors[~asks], heads, k + 1)
        columns = [pa.array(ids[asks][q]), pa.array(ids[~asks][r]), pa.array(heads[r]), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, ["q", "cls", "head", "score"])

    both = rows.unionByName(asking).groupBy("curve", "block")
    met = both.applyInArrow(meet, "q long, cls long, head long, score double")
    return met.groupBy("q", "cls", "head").agg(F.max("score").alias("score"))


def neighbours(
    table: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    every: int = 50,
    k: int = 5,
    curves: int = CURVES,
) -> DataFrame:
    """The k nearest rows of every row whose id is divisible by ``every``.

    Columns: ``query_id, rank, vec_id, score``, nearest first, ties to the smaller id. Rows
    without an id, and vectors that are null, zero, hold a null or a value that is not finite, or
    differ in length from most, take no part. Rows that repeat an id and its vector count once;
    an id with several vectors is a candidate with each and asks with each. Equal vectors are one
    point of the curves, of which the k + 1 smallest ids are kept: no more can be among the k
    nearest. An empty table gives no rows; further columns are ignored.
    """
    spark = prepare(table.sparkSession)
    rows = usable(table, id_column, vector_column)
    key = [F.xxhash64("v").alias("h1"), F.xxhash64(F.reverse("v"), F.lit(1)).alias("h2")]
    rows = rows.select("vec_id", "v", *key)
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    # Of a large group of equal vectors each task sends its first few rows only.
    first = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= 2 * (k + 1))
    first = stored(first)
    heads = first.where("nth = 1").select("h1", "h2", F.col("vec_id").alias("head"), "v")
    # An id can stand for several vectors, so classes are numbered by a hash of id and vector.
    # Of equal scores the classes with the smallest heads hold the smallest ids.
    classes = stored(heads.select(F.xxhash64("head", "h1", "h2").alias("cls"), "v", "head", "h1", "h2"))
    vectors = classes.select("cls", "v", "head")
    named = classes.select("cls", "h1", "h2")
    members = first.join(named, ["h1", "h2"]).select("cls", "vec_id").distinct()
    asking = rows.where(F.col("vec_id") % every == 0).select("vec_id", "h1", "h2").distinct()
    asking = stored(asking.join(named, ["h1", "h2"]).select(F.col("vec_id").alias("query_id"), "cls"))
    queries = asking.select("cls").distinct()
    sample = vectors.orderBy(F.xxhash64("cls"), "cls").limit(SCALE_SAMPLE).collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    unit = np.array([r["v"] for r in sample], np.float64)
    unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
    ranked = stored(_ranked(vectors, Curves(unit, curves)))
    window = _window(vectors, queries, ranked, k)
    found = _candidates(vectors, queries, ranked, window, k)
    best = Window.partitionBy("q").orderBy(F.desc("score"), "head", "cls")
    near = found.withColumn("nth", F.row_number().over(best))
    # Classes with equal scores are kept together: which of their rows come first is seen below.
    edge = near.where(F.col("nth") == k + 1).select("q", F.col("score").alias("edge"))
    near = near.join(edge, "q", "left").where(F.col("edge").isNull() | (F.col("score") >= F.col("edge")))
    near = near.select(F.col("q"), F.col("cls").alias("near"), "score")
    expanded = near.join(members.withColumnRenamed("cls", "near"), "near")
    pairs = asking.join(expanded, asking["cls"] == expanded["q"]).where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return pairs.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
