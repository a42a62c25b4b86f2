"""Byte-level BPE: pre-tokens without regular expressions, cached pair merges, exact decoding.

A text becomes an array of character classes. A small automaton decides where pre-tokens start;
its transitions are functions on eight states, and function composition is associative, so the
automaton runs as a scan: blocks of characters are composed side by side, then the blocks are
chained. The functions that can occur are enumerated once, and composing two of them is a table
lookup. The resulting slices are merged by rank and kept in a bounded cache.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.common import BYTE_VALUES, prepare, span_hashes, text_slices, whole_texts

BLOCK = 256
CACHE_ENTRIES = 400_000

# Character classes.
_LETTER, _NUMBER, _OTHER, _SPACE, _WHITE = range(5)
# Symbols: the class, and what the next characters say. A contraction has one or two letters.
_L, _N, _O, _C1, _C2, _SP, _SP_RUN, _WS, _WS_RUN = range(9)
_FIRST = 9  # the same at the first character of a text
_PAD = 18
# States.
_START, _IN_L, _IN_N, _IN_O, _AFTER_SPACE, _IN_RUN, _ONE_LEFT, _TWO_LEFT = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a pre-token starts at this character."""
    if symbol == _PAD:
        return state, False
    if symbol >= _FIRST:
        return _step(_START, symbol - _FIRST)
    if state == _TWO_LEFT:
        return _ONE_LEFT, False
    if state == _ONE_LEFT:
        return _START, False
    if symbol in (_L, _N, _O):
        inside = {_L: _IN_L, _N: _IN_N, _O: _IN_O}[symbol]
        return inside, state not in (inside, _AFTER_SPACE)
    if symbol in (_C1, _C2):
        if state in (_IN_O, _AFTER_SPACE):
            return _IN_O, False
        return (_ONE_LEFT if symbol == _C1 else _TWO_LEFT), True
    if symbol == _SP:
        return _AFTER_SPACE, True
    if symbol == _WS:
        return _START, True
    return _IN_RUN, state != _IN_RUN


@cache
def _scan_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Function after symbol, state after function, start marks, and the identity's number."""
    symbols, states = range(_PAD + 1), range(8)
    generators = [tuple(_step(s, x)[0] for s in states) for x in symbols]
    number = {tuple(states): 0}
    pending = [tuple(states)]
    rows = []
    while pending:
        f = pending.pop(0)
        row = []
        for g in generators:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(number)
                pending.append(h)
            row.append(number[h])
        rows.append(row)
    apply = np.array(list(number), np.uint8)
    marks = np.array([[_step(s, x)[1] for x in symbols] for s in states])
    return np.array(rows, np.uint16), apply, marks, 0


@cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, _OTHER, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, points))
    points = np.array(points)
    for pattern, value in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\p{White_Space}+", _WHITE)):
        for found in regex.finditer(pattern, text):
            table[points[found.start() : found.end()]] = value
    table[32] = _SPACE
    return table


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes and the byte each starts at."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    point = buf[at].astype(np.int32)
    more = np.flatnonzero(point >= 0xC0)
    lead = point[more]
    where = at[more]
    padded = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.int32)
    b1, b2, b3 = (padded[where + k] & 0x3F for k in (1, 2, 3))
    point[more] = np.where(
        lead < 0xE0,
        (lead & 0x1F) << 6 | b1,
        np.where(
            lead < 0xF0,
            (lead & 0x0F) << 12 | b1 << 6 | b2,
            (lead & 0x07) << 18 | b1 << 12 | b2 << 6 | b3,
        ),
    )
    return point, at


def _symbols(point: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The symbol of every character; ``first`` marks the first characters of texts."""
    n = len(point)
    kind = _classes()[point]
    solid_next = np.zeros(n, bool)
    solid_next[:-1] = (kind[1:] < _SPACE) & ~first[1:]
    symbol = kind.copy()
    symbol[kind == _SPACE] = _SP_RUN
    symbol[kind == _WHITE] = _WS_RUN
    symbol[(kind >= _SPACE) & solid_next] -= 1
    quote = np.flatnonzero(point == 0x27)
    if len(quote):
        wide = np.concatenate([point, [0, 0]])
        breaks = np.concatenate([first, [True, True]])
        one, two = wide[quote + 1], wide[quote + 2]
        near = ~breaks[quote + 1]
        far = near & ~breaks[quote + 2]
        letters = [tuple(map(ord, x)) for x in ("re", "ve", "ll")]
        symbol[quote[near & np.isin(one, list(map(ord, "stmd")))]] = _C1
        symbol[quote[far & np.logical_or.reduce([(one == a) & (two == b) for a, b in letters])]] = _C2
    symbol[first] += _FIRST
    return symbol


def pretoken_starts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The byte at which every pre-token of the texts starts."""
    if len(buf) == 0:
        return np.zeros(0, np.int64)
    after, apply, marks, identity = _scan_tables()
    point, at = code_points(buf)
    begins = offsets[:-1][np.diff(offsets) > 0]
    first = np.zeros(len(point), bool)
    first[np.searchsorted(at, begins)] = True
    symbol = _symbols(point, first)
    blocks = -(-len(symbol) // BLOCK)
    padded = np.full(blocks * BLOCK, _PAD, np.uint8)
    padded[: len(symbol)] = symbol
    by_step = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    # Compose the functions of each block, all blocks side by side.
    composed = np.empty((BLOCK + 1, blocks), np.uint16)
    composed[0] = identity
    flat, width = after.ravel(), after.shape[1]
    for t in range(BLOCK):
        np.take(flat, composed[t].astype(np.int32) * width + by_step[t], out=composed[t + 1])
    # Chain the blocks, then every character has the state before it.
    state, entry = _START, np.empty(blocks, np.uint8)
    for b, f in enumerate(composed[BLOCK].tolist()):
        entry[b] = state
        state = int(apply[f, state])
    before = apply.ravel()[composed[:BLOCK].astype(np.int32) * 8 + entry]
    start = marks.ravel()[before.astype(np.int32) * marks.shape[1] + by_step]
    return at[np.flatnonzero(start.T.ravel()[: len(symbol)])]


class Decoder:
    """Bytes of ids, with the offset of every token in them."""

    def __init__(self, ranks: dict[bytes, int]):
        words = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            words[rank] = token
        self.length = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(words), np.uint8)

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The first byte of every token, and the length of the text."""
        return np.concatenate([[0], np.cumsum(self.length[ids])])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes, and the offsets."""
        at = self.offsets(ids)
        shift = np.repeat(self.start[ids] - at[:-1], self.length[ids])
        return self.bytes[np.arange(at[-1]) + shift], at


class Encoder:
    """Ids of texts by a rank file. ``special`` are strings that stand for ids of their own."""

    def __init__(self, ranks: dict[bytes, int], special: dict[bytes, int] | None = None):
        self.ranks = ranks
        self.special = special or {}
        self.decoder = Decoder(ranks | self.special)
        self.kept: dict[bytes, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, the leftmost of equal ones, until none is left."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        return self._merge_short(piece) if len(piece) <= 64 else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> list[int]:
        """By a scan for the lowest rank."""
        rank, none = self.ranks.get, 1 << 40
        cut = list(range(len(piece) + 1))
        pair = [rank(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pair:
            best = min(pair)
            if best == none:
                break
            i = pair.index(best)
            del cut[i + 1], pair[i]
            if i:
                pair[i - 1] = rank(piece[cut[i - 1] : cut[i + 1]], none)
            if i < len(pair):
                pair[i] = rank(piece[cut[i] : cut[i + 2]], none)
        return [self.ranks[piece[a:b]] for a, b in zip(cut[:-1], cut[1:])]

    def _merge_long(self, piece: bytes) -> list[int]:
        """By a heap, so that one piece of a megabyte takes no square of its length."""
        ranks, n = self.ranks, len(piece)
        part = [piece[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, 1, 1) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size, next_size = heapq.heappop(heap)
            j = right[i]
            if len(part[i]) != size or j >= n or len(part[j]) != next_size:
                continue  # one of the two has been merged meanwhile
            part[i] += part[j]
            part[j] = b""
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < n and (rank := ranks.get(part[a] + part[b])) is not None:
                    heapq.heappush(heap, (rank, a, len(part[a]), len(part[b])))
        return [ranks[p] for p in part if p]

    def _ids(self, piece: bytes) -> list[int]:
        ids = self.kept.get(piece)
        if ids is None:
            if len(self.kept) >= CACHE_ENTRIES:
                self.kept.clear()
            ids = self.kept[piece] = self.merge(piece)
        return ids

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the n + 1 offsets of the texts in them.

        Equal pieces of a slice are found by their hash and looked up once. Decoding has to
        give the input again; if a hash ever stood for two pieces, each is looked up.
        """
        raw = buf.tobytes()
        named = sorted((i, name) for name in self.special for i in _places(raw, name))
        starts = pretoken_starts(buf, offsets) if not named else self._around(raw, offsets, named)
        ends = np.append(starts[1:], len(raw))
        _, first, which = np.unique(
            span_hashes(BYTE_VALUES[buf], starts, ends), return_index=True, return_inverse=True
        )
        ids, count = self._look_up(raw, starts[first], ends[first], which)
        back, _ = self.decoder.decode(ids)
        if not np.array_equal(back, buf):
            ids, count = self._look_up(raw, starts, ends, np.arange(len(starts)))
        tokens = np.concatenate([[0], np.cumsum(count)])
        return ids, tokens[np.searchsorted(starts, offsets)]

    def _look_up(self, raw, starts, ends, which) -> tuple[np.ndarray, np.ndarray]:
        look = self._ids
        kinds = [look(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        size = np.array([len(k) for k in kinds], np.int64)
        flat = np.fromiter((x for k in kinds for x in k), np.uint32, int(size.sum()))
        begin = np.cumsum(size) - size
        count = size[which]
        at = np.cumsum(count) - count
        total = int(count.sum())
        return flat[np.arange(total) + np.repeat(begin[which] - at, count)], count

    def _around(self, raw, offsets, named) -> np.ndarray:
        """Starts of pieces where the strings of special tokens stand for themselves."""
        cuts, pieces = set(offsets.tolist()), []
        free = 0
        for at, name in named:
            end = at + len(name)
            inside = np.searchsorted(offsets, at, side="right") == np.searchsorted(offsets, end)
            if at >= free and inside:
                pieces.append(at)
                cuts |= {at, end}
                free = end
        bounds = np.array(sorted(cuts))
        starts = pretoken_starts(np.frombuffer(raw, np.uint8), bounds)
        block = np.searchsorted(bounds, starts, side="right") - 1
        special = np.isin(bounds[block], pieces)
        for at in pieces:
            self.kept[raw[at : bounds[np.searchsorted(bounds, at, side="right")]]] = [
                self.special[raw[at : bounds[np.searchsorted(bounds, at, side="right")]]]
            ]
        return np.unique(np.concatenate([starts[~special], np.array(pieces, np.int64)]))


def _places(raw: bytes, name: bytes) -> Iterator[int]:
    at = raw.find(name)
    while at >= 0:
        yield at
        at = raw.find(name, at + 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    import base64

    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(p[0]): int(p[1]) for p in pairs if len(p) == 2}


@cache
def encoder(path: str, special: tuple[tuple[bytes, int], ...] = ()) -> Encoder:
    """One encoder per Python worker and rank file; the file is read where the task runs."""
    return Encoder(read_ranks(path), dict(special))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of 32-bit values as one binary cell each."""
    data = pa.py_buffer(np.ascontiguousarray(values, "<u4").tobytes())
    at = pa.py_buffer((bounds * 4).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, at, data])


def encode(docs: DataFrame, file: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """``doc_id`` and the ids of every whole text as bytes (``ids``), with token offsets.

    ``ids`` and ``offsets`` hold little-endian unsigned 32-bit integers; ``offsets`` has the
    first byte of every token. A null or empty text has none. Every row is encoded by itself:
    repeated rows, null ids and further columns change nothing.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary(file))
        for batch in batches:
            for low, high, buf, offsets in text_slices(batch.column(1)):
                ids, bounds = enc.encode(buf, offsets)
                at = enc.decoder.offsets(ids)[:-1] - np.repeat(offsets[:-1], np.diff(bounds))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], _packed(ids, bounds), _packed(at, bounds)],
                    ["doc_id", "ids", "offsets"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, offsets binary"
    return whole_texts(docs, "doc_id").mapInArrow(run, schema)


def decode(encoded: DataFrame, file: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """The rows of ``encode`` with the decoded bytes (``decoded``) of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = encoder(vocabulary(file)).decoder
        for batch in batches:
            for low, high, buf, offsets in text_slices(batch.column("ids")):
                out, at = dec.decode(np.frombuffer(buf.tobytes(), "<u4"))
                ends = pa.py_buffer(at[offsets // 4].astype(np.int32).tobytes())
                texts = pa.Array.from_buffers(
                    pa.binary(), high - low, [None, ends, pa.py_buffer(out.tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[low:high], batch.column("ids")[low:high], texts],
                    ["doc_id", "ids", "decoded"],
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    table = encoded.select("doc_id", "ids")
    return table.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def digests(docs: DataFrame, file: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of what they decode to."""
    return decode(encode(docs, file), file).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
