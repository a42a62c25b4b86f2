"""Fill-in-middle transformation whose cuts come from a learned rank index.

A text is cut at token boundaries that are given by their rank, so the offset of the k-th boundary
is needed. The offsets of all boundaries are fitted by straight pieces whose error is bounded; what
a piece misses is stored as one byte a boundary. A cut is predicted from its rank and corrected
exactly by the stored byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.common import byte_class, prepare, text_slices, whole_texts

#: Largest error of a piece; residuals then fit a byte.
ERROR = 100
#: Boundaries are found and fitted so many bytes at a time, so a long text needs little memory.
BLOCK_BYTES = 1 << 20

# The marks of the parts, the shares and the seed of the cuts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
SEED = "1:"

_LETTER = byte_class(bytes(range(65, 91)) + bytes(range(97, 123)))


# ---- rank index -------------------------------------------------------------------------------


@dataclass(frozen=True)
class RankIndex:
    """Pieces (first rank, its offset, rise and run of the line) and a residual per rank."""

    rank: np.ndarray
    offset: np.ndarray
    rise: np.ndarray
    run: np.ndarray
    residual: np.ndarray

    def lookup(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of the given ranks."""
        at = np.searchsorted(self.rank, ranks, side="right") - 1
        line = self.offset[at] + (ranks - self.rank[at]) * self.rise[at] // self.run[at]
        return line + self.residual[ranks]


def fit(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """Pieces through rising offsets; a piece that misses one by more than ``error`` is halved."""
    n = len(offsets)
    low, high = np.zeros(min(n, 1), np.int64), np.full(min(n, 1), n, np.int64)
    residual = np.zeros(n, np.int8)
    done = []
    while len(low):
        size = high - low
        first = np.cumsum(size) - size
        piece = np.repeat(np.arange(len(low)), size)
        ranks = np.arange(len(piece)) - first[piece] + low[piece]
        rise, run = offsets[high - 1] - offsets[low], np.maximum(size - 1, 1)
        line = offsets[low][piece] + (ranks - low[piece]) * rise[piece] // run[piece]
        missed = offsets[ranks] - line
        fits = np.maximum.reduceat(np.abs(missed), first) <= error
        kept = fits[piece]
        residual[ranks[kept]] = missed[kept]
        done.append((low[fits], offsets[low[fits]], rise[fits], run[fits]))
        low, high = low[~fits], high[~fits]
        middle = (low + high) // 2
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
        order = np.argsort(low)
        low, high = low[order], high[order]
    parts = [np.concatenate(p) for p in zip(*done)] if done else [np.zeros(0, np.int64)] * 4
    order = np.argsort(parts[0])
    return RankIndex(*(p[order] for p in parts), residual)


def _joined(blocks: list[RankIndex]) -> RankIndex:
    """Indexes of neighbouring stretches as one."""
    before = np.cumsum([0] + [len(b.residual) for b in blocks[:-1]])
    return RankIndex(
        np.concatenate([b.rank + n for b, n in zip(blocks, before)]),
        *(np.concatenate([getattr(b, name) for b in blocks]) for name in ("offset", "rise", "run", "residual")),
    )


def token_index(buf: np.ndarray, offsets: np.ndarray) -> tuple[RankIndex, np.ndarray]:
    """The index of all token starts and of the end, and the rank of the first token of every text.

    A token is a run of the letters A-Z and a-z or one other character. The first start of a text
    is the end of the one before, so one index serves all texts of the slice.
    """
    blocks, firsts, seen = [], [], 0
    edges = offsets[:-1]
    for low in range(0, len(buf), BLOCK_BYTES):
        part = buf[low : low + BLOCK_BYTES]
        letter = _LETTER[part]
        inside = np.empty(len(part), bool)
        inside[0] = letter[0] and low > 0 and _LETTER[buf[low - 1]]
        inside[1:] = letter[1:] & letter[:-1]
        inside[edges[(edges >= low) & (edges < low + len(part))] - low] = False
        starts = np.flatnonzero(~inside & ((part & 0xC0) != 0x80)) + low
        firsts.append(np.searchsorted(starts, edges[(edges >= low) & (edges < low + len(part))]) + seen)
        blocks.append(fit(starts))
        seen += len(starts)
    blocks.append(fit(np.array([len(buf)])))
    # Texts that begin at the end are empty.
    firsts.append(np.full(int((edges >= len(buf)).sum()) + 1, seen))
    return _joined(blocks), np.concatenate(firsts)


# ---- transformation ---------------------------------------------------------------------------


def characters(raw: np.ndarray) -> int:
    """Code points of bytes in UTF-8."""
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    draws = np.array([batch.column(f"h{i}").to_numpy() for i in range(1, 5)], np.int64)
    for low, high, buf, offsets in text_slices(batch.column("text")):
        index, first = token_index(buf, offsets)
        n = np.diff(first)
        h1, h2, h3, h4 = draws[:, low:high]
        ends = np.sort([h1 % (n + 1), h2 % (n + 1)], axis=0)
        cuts = index.lookup(first[:-1] + ends)
        forms, outputs, counts = [], [], []
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            raw = buf[a:b].tobytes()
            if not raw or h3[i] % 100 >= PLAIN_FROM or any(mark in raw for mark in marks):
                forms.append("plain")
                outputs.append(raw)
                counts.append((None, None))
                continue
            c, d = int(cuts[0, i]), int(cuts[1, i])
            prefix, middle, suffix = (buf[x:y].tobytes() for x, y in ((a, c), (c, d), (d, b)))
            forms.append("spm" if h4[i] % 100 < SPM_BELOW else "psm")
            if forms[-1] == "spm":
                outputs.append(b"".join((s, suffix, p, prefix, m, middle)))
            else:
                outputs.append(b"".join((p, prefix, s, suffix, m, middle)))
            counts.append((characters(buf[a:c]), characters(buf[c:d])))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").slice(low, high - low),
                pa.array(n, pa.int64()),
                pa.array(forms, pa.string()),
                pa.array([c for c, _ in counts], pa.int64()),
                pa.array([c for _, c in counts], pa.int64()),
                pa.array(outputs, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def transformed(docs: DataFrame) -> DataFrame:
    """Per document its text with the middle part moved to the end.

    Columns: ``doc_id``, ``n`` (tokens), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (code points, null if plain), ``output``. The draws are digits of the SHA-256
    of the seed and the ``doc_id``; a null ``doc_id`` counts as empty there. A null text counts as
    empty and is plain with no tokens. Repeated rows give equal rows; an empty table gives no rows;
    further columns are ignored. A text is handled whole: a task needs about eight bytes of memory
    a byte of its longest text, plus some dozen bytes for each of BLOCK_BYTES bytes.
    """
    prepare(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [
        F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)
    ]
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _cut(batch)

    return whole_texts(docs, "doc_id").select("doc_id", "text", *draws).mapInArrow(cut, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from, read off the marks alone.

    A plain output is the text. No mark occurs within the parts of the others, so the first of
    each kind is the one that was set.
    """
    length = len(PREFIX)

    def after(text: Column, part: Column) -> Column:
        """What follows the part and one mark."""
        return F.substring(text, F.char_length(part) + length + 1, F.char_length(text))

    def parts(second: str) -> tuple[Column, Column, Column]:
        body = after(output, F.lit(""))
        one = F.substring_index(body, second, 1)
        rest = after(body, one)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, after(rest, two)

    prefix, suffix, middle = parts(SUFFIX)
    last, start, centre = parts(PREFIX)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(start, centre, last))
    )


def digests(docs: DataFrame) -> DataFrame:
    """``transformed`` with digests of the output and of the text rebuilt from it.

    Rows as in ``transformed``; ``output_sha256`` and ``restored_sha256`` are in lower-case hex.
    """
    found = transformed(docs)
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
