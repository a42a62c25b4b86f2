"""WARC archives with revisit records, and one globally ordered index of their captures.

Archives are written and read by Spark's file sources, so they land in the shared folder through
Spark's committer. Reading an archive gives its captures as a run sorted by URL key and time.
The runs are cut at common split keys, and every key range is merged on its own by a loser tree
over the segments of all runs: the ranges in order are the global index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
import re
import struct
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.llm.common import prepare, shared_folder, stored

RECORDS_PER_FILE = 2000
RANGE_CAPTURES = 100_000
SPLIT_SAMPLE = 20_000
#: 2024-01-01; a page's capture time is its number of seconds after it, begun anew after _SPAN.
_EPOCH, _SPAN = 1_704_067_200, 6_000_000_000
_CRLF = "\r\n"


# ---- records ----------------------------------------------------------------------------------


def url_key(url: str | None) -> str:
    """The sort key of a URL: host parts from the top domain on, then path and query."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:  # not a URL
        return (url or "").strip().lower()
    if not host:
        return (url or "").strip().lower()
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    port = f":{port}" if port and (parts.scheme, port) not in {("http", 80), ("https", 443)} else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{labels}{port}){parts.path or '/'}{query}"


def _digest(payload: pa.Array) -> pa.Array:
    return pa.array(
        [base64.b32encode(hashlib.sha1(x.as_buffer()).digest()).decode() for x in payload], pa.string()
    )


def _header_text(column):
    """A header value on one line; characters that would end it are escaped.

    So is the sign of the escapes where they could be read as one.
    """
    marked = F.regexp_replace(column, "%(?=(25)*0[AD])", "%25")
    return F.replace(F.replace(marked, F.lit("\n"), F.lit("%0A")), F.lit("\r"), F.lit("%0D"))


_ESCAPES = re.compile("%25(?=(?:25)*0[AD])|%0A|%0D")


def _header_value(text: str) -> str:
    """The value of an escaped header."""
    return _ESCAPES.sub(lambda m: {"%0A": "\n", "%0D": "\r"}.get(m[0], "%"), text)


def _identity(column):
    return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("null")), F.lit(">"))


def record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, refers_to``.

    Of equal payloads of at least ``least_bytes`` bytes the page with the smallest id is the
    response; ``refers_to`` has its id in the others. The join meets one row per digest.
    """
    text = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digest = F.arrow_udf(_digest, "string")
    rows = text.select(
        "*",
        F.octet_length("html").cast("long").alias("payload_bytes"),
        digest("html").alias("payload_digest"),
    )
    narrow = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest")
    first = narrow.agg(F.min("page_id").alias("response"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(first.drop("n"), "payload_digest", "left")
    other = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(other, F.col("response")).alias("refers_to"),
    )


def record(page_id, url, html, payload_bytes, digest, refers_to):
    """One WARC record as text, without the last line break, which the writer adds."""
    revisit = refers_to.isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(html)
    seconds = F.pmod(F.coalesce(page_id.cast("long"), F.lit(0)), F.lit(_SPAN)) + _EPOCH
    # A timestamp without a zone, so that the zone of the session has no part in it.
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    moment = start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    date = F.concat(F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    refers = F.when(
        revisit,
        F.concat(
            F.lit("WARC-Refers-To: "), _identity(refers_to), F.lit(_CRLF),
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + _CRLF),
        ),
    ).otherwise(F.lit(""))
    return F.concat(
        F.lit("WARC/1.1" + _CRLF + "WARC-Type: "), kind,
        F.lit(_CRLF + "WARC-Record-ID: "), _identity(page_id),
        F.lit(_CRLF + "WARC-Date: "), date,
        F.lit(_CRLF + "WARC-Target-URI: "), _header_text(F.coalesce(url, F.lit(""))),
        F.lit(_CRLF + "WARC-Payload-Digest: sha1:"), digest, F.lit(_CRLF), refers,
        F.lit("X-Payload-Length: "), payload_bytes.cast("string"),
        F.lit(_CRLF + "Content-Type: text/html; charset=utf-8"),
        F.lit(_CRLF + "Content-Length: "), F.octet_length(block).cast("string"),
        F.lit(_CRLF + _CRLF), block, F.lit(_CRLF),
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Write a WARC record per page into gzipped archives of a bounded number of records."""
    prepare(pages.sparkSession)
    rows = record_types(pages, least_bytes)
    names = ["page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to"]
    text = rows.select(record(*(F.col(n) for n in names)).alias("value"))
    writer = text.write.option("lineSep", _CRLF).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record, by Content-Length."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        yield headers, block


def _page(identity: str) -> int | None:
    value = identity.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "null" else int(value)


# ---- runs -------------------------------------------------------------------------------------

_CAPTURE = (
    "url_key string, captured long, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)
_FIELDS = ["url_key", "captured", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def sort_key(url: str, captured: int, page_id: int | None) -> bytes:
    """Bytes that sort as URL key, time and page id do; a null id comes first."""
    number = 0 if page_id is None else page_id + (1 << 63)
    known = b"\0" if page_id is None else b"\1"
    return url.encode() + b"\0" + struct.pack(">Q", captured + (1 << 63)) + known + struct.pack(">Q", number)


def _captures(content: bytes) -> list[tuple]:
    found = []
    with gzip.open(io.BytesIO(content)) as stream:
        for headers, block in read_records(stream):
            digest = headers["warc-payload-digest"].removeprefix("sha1:")
            kind = headers["warc-type"]
            if kind == "response":
                size = len(block)
                digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
            else:
                size = int(headers["x-payload-length"])
            captured = int(pd.Timestamp(headers["warc-date"]).timestamp())
            refers = headers.get("warc-refers-to")
            page = _page(headers["warc-record-id"])
            key = url_key(_header_value(headers["warc-target-uri"]))
            found.append(
                (key, captured, page, size, digest, kind, _page(refers) if refers else None)
            )
    return found


def archive_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of every archive as one sorted run: ``run, place, key`` and the fields."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                keyed = sorted(
                    ((sort_key(*c[:3]), c) for c in _captures(content.as_py())), key=lambda x: x[0]
                )
                columns = list(zip(*(c for _, c in keyed))) or [()] * len(_FIELDS)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([run] * len(keyed), pa.string()),
                        pa.array(range(len(keyed)), pa.int32()),
                        pa.array([k for k, _ in keyed], pa.binary()),
                        *(pa.array(list(c), k) for c, k in zip(columns, kinds)),
                    ],
                    ["run", "place", "key", *_FIELDS],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    schema = f"run string, place int, key binary, {_CAPTURE}"
    return files.select("path", "content").mapInArrow(parse, schema)


# ---- merge ------------------------------------------------------------------------------------


class LoserTree:
    """Merge k sorted iterators: every inner node keeps the loser of its match.

    The next smallest item costs one match per level on the path of the last winner.
    """

    def __init__(self, runs: list[Iterator[tuple]]):
        self.k = max(1, len(runs))
        self.runs = runs or [iter(())]
        self.head = [next(run, None) for run in self.runs]
        self.tree = [-1] * self.k
        for run in range(self.k):
            self._play(run)

    def _wins(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node > 0:
            if self.tree[node] < 0:  # its other player is still to come
                self.tree[node] = run
                return
            if self._wins(self.tree[node], run):
                self.tree[node], run = run, self.tree[node]
            node //= 2
        self.tree[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while (item := self.head[winner := self.tree[0]]) is not None:
            yield item
            self.head[winner] = next(self.runs[winner], None)
            node, run = (winner + self.k) // 2, winner
            while node > 0:
                if self._wins(self.tree[node], run):
                    self.tree[node], run = run, self.tree[node]
                node //= 2
            self.tree[0] = run


def split_keys(runs: DataFrame, ranges: int) -> list[bytes]:
    """Keys that cut the index into about equal ranges, from a sample of bounded size.

    The sample only balances the ranges. The key ends with time and page, so captures of one
    URL can be cut too.
    """
    if ranges <= 1:
        return []
    sample = runs.select("key").orderBy(F.xxhash64("key"), "key").limit(SPLIT_SAMPLE).collect()
    keys = sorted({bytes(r[0]) for r in sample})
    return [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures in global order of URL key, time and page.

    Columns: the capture's fields, ``range_no`` and ``place_in_range``: sorted by these two, the
    rows are the index. ``runs`` is a written table of sorted runs.
    """
    total = runs.count()
    ranges = max(1, math.ceil(total / RANGE_CAPTURES))
    splits = split_keys(runs, min(ranges, SPLIT_SAMPLE // 4))

    def cut(keys: pa.Array) -> pa.Array:
        import bisect

        return pa.array([bisect.bisect_right(splits, k.as_py()) for k in keys], pa.int32())

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        segments = []
        for _, segment in rows.groupby("run", sort=True):
            segment = segment.sort_values("place")  # as the archive's run has them
            segments.append(zip(segment["key"], segment.index))
        order = [index for _, index in LoserTree([iter(s) for s in segments])]
        merged = rows.loc[order, _FIELDS].reset_index(drop=True)
        for name in ("captured", "page_id", "payload_bytes", "refers_to"):
            merged[name] = merged[name].astype("Int64")
        return merged.assign(range_no=key[0], place_in_range=range(len(merged)))

    ranged = runs.withColumn("range_no", F.arrow_udf(cut, "int")("key"))
    return ranged.groupBy("range_no").applyInPandas(
        merge, f"{_CAPTURE}, range_no int, place_in_range long"
    )


def capture_index(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages as WARC archives, read them back and merge the captures.

    Columns: ``page_id, payload_bytes, payload_digest, record_type, refers_to`` and the place in
    the index. A null page gives an empty payload, a null URL an empty key; a null ``page_id``
    is a response if its payload is its own, else it refers to the smallest id. Rows that repeat
    a ``page_id`` with the same payload are responses each. An empty table gives no rows,
    further columns are ignored.
    """
    spark = prepare(pages.sparkSession)
    folder = shared_folder(spark)
    write_archives(pages, folder, least_bytes)
    if spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).isEmpty():
        columns = f"{_CAPTURE}, range_no int, place_in_range long"
        merged = spark.createDataFrame([], columns)
    else:
        merged = merge_runs(stored(archive_runs(spark, folder)))
    return merged.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        "url_key", "captured", "range_no", "place_in_range",
    )
