"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes.

The field is trained in numpy on a small labelled table of token sequences and decodes all lines of
a slice of texts side by side by Viterbi. Its features are shapes: runs of character classes,
digits, length and the shapes of both neighbours. What the patterns find always stays; the field
adds spans that do not overlap them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.common import (
    WORD,
    prepare,
    span_hashes,
    spans,
    text_slices,
    whole_texts,
)

KINDS = ("email", "ip", "card", "phone")
#: Tags: 0 is outside; kind k begins with 1 + 2 k and goes on with 2 + 2 k.
TAGS = 1 + 2 * len(KINDS)

# ---- patterns ---------------------------------------------------------------------------------

# Fixed values.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from the @ outwards.

    The leftmost match that ends in a domain starts where the characters before the @ begin,
    or where the last match ended. So a long word without @ takes no square of its length.
    """
    free = 0
    for found in _DOMAIN.finditer(text):
        start = found.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            yield start, found.end()
            free = found.end()


def _luhn(digits: list[int]) -> bool:
    doubled = (2 * d - 9 * (d > 4) for d in digits[-2::-2])
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns in code points, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(int(x) <= 255 for x in m[0].split(".") if len(x) <= 4300) and _short(m[0]):
            out.append((1, m.start(), m.end()))
    for kind, pattern, least, most in ((2, _CARD, 16, 19), (3, _PHONE, 8, 15)):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            if least <= len(digits) <= most and (kind == 3 or _luhn(digits)):
                out.append((kind, m.start(), m.end()))
    return out


def _short(address: str) -> bool:
    """Whether every part is at most 255 also where it is too long for a number."""
    return all(len(x.lstrip("0")) <= 3 for x in address.split("."))


# ---- tokens and features ----------------------------------------------------------------------

# Character classes of a shape: upper, lower (and all beyond ASCII), digit, and marks by themselves.
_SHAPE = np.full(256, 4, np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:], _SHAPE[48:58] = 1, 2, 2, 3
for _n, _mark in enumerate(b"@.+-()=:/%_,"):
    _SHAPE[_mark] = 5 + _n
_SHAPE_VALUES = np.random.default_rng(5).integers(1, 1 << 63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_HASHED = 1 << 11
_TEMPLATES = 6


@dataclass
class Tokens:
    start: np.ndarray  # bytes
    end: np.ndarray
    line: np.ndarray  # sequence each token belongs to
    features: np.ndarray  # tokens by templates


def tokens(buf: np.ndarray, offsets: np.ndarray) -> Tokens:
    """The blank-separated words of the texts; a sequence is a line of one text."""
    start, end = spans(WORD[buf], offsets)
    breaks = np.union1d(np.flatnonzero(buf == 10), offsets)
    line = np.searchsorted(breaks, start, side="right")
    kind = _SHAPE[buf]
    change = np.ones(len(buf), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[start] = True
    runs = np.flatnonzero(change)
    shape = span_hashes(
        _SHAPE_VALUES[kind[runs]], np.searchsorted(runs, start), np.searchsorted(runs, end)
    )
    digits = np.concatenate([[0], np.cumsum(kind == 3, dtype=np.int32)])
    count = np.minimum(digits[end] - digits[start], 15)
    length = np.minimum(end - start, 31)
    own = (shape % np.uint64(_HASHED)).astype(np.int32)
    n = len(start)
    same_before = np.zeros(n, bool)
    same_before[1:] = line[1:] == line[:-1]
    before = np.full(n, _HASHED, np.int32)
    before[1:] = np.where(same_before[1:], own[:-1], _HASHED)
    after = np.full(n, _HASHED, np.int32)
    after[:-1] = np.where(same_before[1:], own[1:], _HASHED)
    first = kind[start] if n else start
    last = kind[end - 1] if n else start
    features = np.empty((n, _TEMPLATES), np.int32)
    width = _HASHED + 1
    for t, column in enumerate(
        (own, before, after, count * 32 + length, first.astype(np.int32) * 32 + last, (count > 0) * 2 + (length > 3))
    ):
        features[:, t] = column + t * width
    return Tokens(start, end, line, features)


# ---- the field --------------------------------------------------------------------------------


@dataclass
class Field:
    weights: np.ndarray  # feature by tag
    moves: np.ndarray  # tag before by tag
    begin: np.ndarray


def _time_major(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of tokens by place in their sequence, longest sequences first; tokens per place."""
    if len(line) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    size = np.diff(np.r_[first, len(line)])
    rank = np.empty(len(size), np.int64)
    rank[np.argsort(-size, kind="stable")] = np.arange(len(size))
    place = np.arange(len(line)) - np.repeat(first, size)
    active = np.bincount(place)
    at = (np.cumsum(active) - active)[place] + np.repeat(rank, size)
    order = np.empty(len(line), np.int64)
    order[at] = np.arange(len(line))
    return order, active


def viterbi(field: Field, found: Tokens) -> np.ndarray:
    """The best tag sequence of every line, all lines a step at a time."""
    order, active = _time_major(found.line)
    n = len(order)
    scores = np.zeros((TAGS, n), np.float32)
    columns = found.features[order]
    for t in range(columns.shape[1]):
        scores += field.weights[columns[:, t]].T
    ends = np.cumsum(active).tolist()
    active = active.tolist()
    moves = field.moves[:, :, None]
    for step, (high, m) in enumerate(zip(ends, active)):
        here = scores[:, high - m : high]
        if step == 0:
            here += field.begin[:, None]
        else:
            low = high - m - active[step - 1]
            here += (scores[:, None, low : low + m] + moves).max(axis=0)
    tags = np.zeros(n, np.int8)
    following = np.zeros(0, np.int8)
    for high, m in zip(ends[::-1], active[::-1]):
        here = scores[:, high - m : high].copy()
        # The first sequences go on: from which tag does the best one come that follows?
        here[:, : len(following)] += field.moves[:, following]
        following = here.argmax(axis=0)
        tags[high - m : high] = following
    out = np.empty(n, np.int8)
    out[order] = tags
    return out


def _forward_backward(scores, mask, moves, begin):
    """Log partition, tag and move marginals of padded sequences, batch by time by tag."""
    b, steps, _ = scores.shape
    alpha = np.empty_like(scores)
    alpha[:, 0] = scores[:, 0] + begin
    for t in range(1, steps):
        joint = alpha[:, t - 1, :, None] + moves
        top = joint.max(axis=1, keepdims=True)
        new = np.log(np.exp(joint - top).sum(axis=1)) + top[:, 0] + scores[:, t]
        alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
    beta = np.zeros_like(scores)
    for t in range(steps - 2, -1, -1):
        joint = moves + (scores[:, t + 1] + beta[:, t + 1])[:, None, :]
        top = joint.max(axis=2, keepdims=True)
        new = np.log(np.exp(joint - top).sum(axis=2)) + top[:, :, 0]
        beta[:, t] = np.where(mask[:, t + 1, None], new, beta[:, t + 1])
    top = alpha[:, -1].max(axis=1)
    whole = np.log(np.exp(alpha[:, -1] - top[:, None]).sum(axis=1)) + top
    tag = np.exp(alpha + beta - whole[:, None, None]) * mask[:, :, None]
    both = mask[:, 1:] & mask[:, :-1]
    pair = np.exp(
        alpha[:, :-1, :, None] + moves + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - whole[:, None, None, None]
    ) * both[:, :, None, None]
    return whole, tag, pair


def train(features: list[np.ndarray], tags: list[np.ndarray], rounds: int = 25) -> Field:
    """Fit by Adam on the likelihood of the labelled sequences, with a small decay."""
    size = _TEMPLATES * (_HASHED + 1)
    field = Field(
        np.zeros((size, TAGS), np.float32), np.zeros((TAGS, TAGS), np.float32), np.zeros(TAGS, np.float32)
    )
    rng = np.random.default_rng(3)
    weights = [field.weights, field.moves, field.begin]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step, per_batch = 0, 64
    for _ in range(rounds if features else 0):
        order = rng.permutation(len(features))
        for low in range(0, len(order), per_batch):
            pick = order[low : low + per_batch]
            longest = max(len(tags[i]) for i in pick)
            x = np.zeros((len(pick), longest, _TEMPLATES), np.int64)
            y = np.zeros((len(pick), longest), np.int64)
            mask = np.zeros((len(pick), longest), bool)
            for r, i in enumerate(pick):
                m = len(tags[i])
                x[r, :m], y[r, :m], mask[r, :m] = features[i], tags[i], True
            scores = field.weights[x].sum(axis=2)
            _, tag, pair = _forward_backward(scores, mask, field.moves, field.begin)
            d_scores = tag
            hot = np.eye(TAGS, dtype=np.float32)[y] * mask[:, :, None]
            d_scores = (d_scores - hot) / len(pick)
            grads = [1e-4 * w for w in weights]
            np.add.at(grads[0], x.ravel(), np.repeat(d_scores.reshape(-1, TAGS), _TEMPLATES, axis=0))
            both = (mask[:, 1:] & mask[:, :-1]).astype(np.float32)
            seen = np.zeros((TAGS, TAGS), np.float32)
            np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), both.ravel())
            grads[1] += (pair.sum(axis=(0, 1)) - seen) / len(pick)
            grads[2] += d_scores[:, 0].sum(axis=0)
            step += 1
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return field


# ---- labelled table ---------------------------------------------------------------------------

SAMPLE_DOCUMENTS = 3000
SAMPLE_SEQUENCES = 2500
_AROUND = 6


def _tags_of(text: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Tags of words at code points from the patterns' spans."""
    tags = np.zeros(len(start), np.int64)
    for kind, a, b in base_spans(text):
        inside = np.flatnonzero((end > a) & (start < b))
        tags[inside] = 2 + 2 * kind
        tags[inside[:1]] = 1 + 2 * kind
    return tags


def labelled_table(docs: DataFrame) -> DataFrame:
    """A small table of labelled sequences: ``words``, ``tags``.

    Taken from at most SAMPLE_DOCUMENTS documents, chosen by a hash of their ids. A sequence is
    what surrounds a word with a digit or an @, or a stretch in the middle of the text; its tags
    come from the patterns.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, tags = [], []
            for text in batch.column(0).to_pylist():
                for line in text.split("\n"):
                    at = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", line)]
                    if not at:
                        continue
                    start, end = np.array(at).T
                    tag = _tags_of(line, start, end) if re.search("[0-9@]", line) else np.zeros(len(at), int)
                    hot = [i for i, (a, b) in enumerate(at) if re.search("[0-9@+]", line[a:b])]
                    centre = [len(at) // 2] if not hot else []
                    done = 0
                    for i in hot + centre:
                        if i < done:
                            continue
                        low, high = max(0, i - _AROUND), min(len(at), i + 2 * _AROUND)
                        words.append([line[a:b] for a, b in at[low:high]])
                        tags.append(tag[low:high].tolist())
                        done = high
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.list_(pa.string())), pa.array(tags, pa.list_(pa.int32()))],
                ["words", "tags"],
            )

    some = docs.where(F.octet_length("text") > 0)
    chosen = some.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS).distinct()
    texts = some.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi").select("text")
    rows = texts.mapInArrow(cut, "words array<string>, tags array<int>")
    # Sequences with a tag first; the others are many and alike.
    outside = ~F.exists("tags", lambda t: t > 0)
    return rows.orderBy(outside, F.xxhash64("words"), "words").limit(SAMPLE_SEQUENCES)


def fit(labelled: DataFrame) -> Field:
    """Train on a labelled table with the columns ``words`` and ``tags``; it must be small."""
    features, tags = [], []
    for words, tag in labelled.select("words", "tags").collect():
        raw = np.frombuffer(" ".join(words).encode(), np.uint8)
        found = tokens(raw, np.array([0, len(raw)]))
        if len(found.start) == len(tag):
            features.append(found.features)
            tags.append(np.array(tag, np.int64))
    return train(features, tags)


# ---- on documents -----------------------------------------------------------------------------

#: Texts that are redacted go out slice by slice; in a row of stages a worker keeps what earlier ones took.
REDACTED_BYTES = 1 << 17

_TRAILING = frozenset(b".,;:!?\"'")


def _added(field: Field, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Spans of the field in bytes: text, kind, start, end. Each has a digit or an @."""
    found = tokens(buf, offsets)
    if len(found.start) == 0:
        return []
    tags = viterbi(field, found)
    inside = np.flatnonzero(tags)
    out = []
    for i in inside.tolist():
        kind, goes_on = (int(tags[i]) - 1) // 2, int(tags[i]) % 2 == 0
        start, end = int(found.start[i]), int(found.end[i])
        if goes_on and out and out[-1][4] == i - 1 and out[-1][1] == kind and out[-1][5] == found.line[i]:
            out[-1][3], out[-1][4] = end, i
        else:
            out.append([0, kind, start, end, i, found.line[i]])
    spans_found = []
    for _, kind, start, end, _, _ in out:
        while end > start and int(buf[end - 1]) in _TRAILING:
            end -= 1
        part = buf[start:end]
        if len(part) and bool(((part >= 48) & (part <= 57) | (part == 64)).any()):
            text = int(np.searchsorted(offsets, start, side="right")) - 1
            spans_found.append((text, kind, start, end))
    return spans_found


def _plausible(kind: int, found: str) -> bool:
    """Whether a span of the field can be of its kind: an email has an @, a card passes Luhn, and so on."""
    digits = [int(c) for c in found if c in "0123456789"]
    if KINDS[kind] == "email":
        return "@" in found
    if KINDS[kind] == "ip":
        return found.count(".") == 3 or ":" in found
    if KINDS[kind] == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return 7 <= len(digits) <= 15


def find_spans(field: Field, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[list[Span], list[Span]]]:
    """Per text the patterns' spans and all spans, in code points, by kind and start."""
    n = len(offsets) - 1
    hot = np.concatenate([[0], np.cumsum(((buf >= 48) & (buf <= 57)) | (buf == 64))])
    base: list[list[Span]] = [[] for _ in range(n)]
    for i in np.flatnonzero(hot[offsets[1:]] > hot[offsets[:-1]]).tolist():
        base[i] = base_spans(buf[offsets[i] : offsets[i + 1]].tobytes().decode())
    whole = [list(b) for b in base]
    characters = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    for i, kind, start, end in _added(field, buf, offsets):
        if not _plausible(kind, buf[start:end].tobytes().decode()):
            continue
        first, last = (int(characters[x] - characters[offsets[i]]) for x in (start, end))
        if all(last <= a or b <= first for _, a, b in base[i]):
            whole[i].append((kind, first, last))
    return [(b, sorted(w)) for b, w in zip(base, whole)]


def _joined(found: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in found)


def spans_of(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Personal data of every whole text.

    Columns: ``doc_id``, the patterns' counts ``n_email, n_ip, n_card, n_phone``, ``base_sha256``
    of the patterns' spans, ``spans`` with those the field adds, and ``n_added``. Spans are
    ``kind:start:end`` in code points. A null or empty text has none. Rows are judged one by
    one, repeated ones too; an empty table gives no rows; further columns are ignored.
    """
    prepare(docs.sparkSession)
    field = field or fit(labelled_table(docs))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, buf, offsets in text_slices(batch.column(1)):
                found = find_spans(field, buf, offsets)
                counts = [
                    pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64())
                    for k in range(len(KINDS))
                ]
                digest = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high],
                        *counts,
                        pa.array(digest, pa.string()),
                        pa.array([_joined(whole) for _, whole in found], pa.string()),
                        pa.array([len(whole) - len(base) for base, whole in found], pa.int64()),
                    ],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return whole_texts(docs, "doc_id").mapInArrow(
        find,
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string, n_added long",
    )


def redact(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, as in ``[EMAIL]``.

    Of overlapping spans the union is replaced, under the kind that starts first. Null texts
    stay null, ``n_chars`` follows the text where there is such a column.
    """
    prepare(docs.sparkSession)
    field = field or fit(labelled_table(docs))

    n_chars = docs.schema.names.index("n_chars") if "n_chars" in docs.columns else -1
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            filled = texts.fill_null("") if texts.null_count else texts
            for low, high, buf, offsets in text_slices(filled, REDACTED_BYTES):
                part = batch.slice(low, high - low)
                out = [buf[offsets[i] : offsets[i + 1]].tobytes().decode() for i in range(high - low)]
                for i, (_, found) in enumerate(find_spans(field, buf, offsets)):
                    if found:
                        out[i] = _without(out[i], found)
                known = part.column(at).is_valid().to_pylist()
                columns = part.columns
                columns[at] = pa.array([x if k else None for x, k in zip(out, known)], texts.type)
                if n_chars >= 0:
                    old = part.column(n_chars)
                    length = [len(x) if k else n for x, k, n in zip(out, known, old.to_pylist())]
                    columns[n_chars] = pa.array(length, old.type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)


def _without(text: str, found: list[Span]) -> str:
    out, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
