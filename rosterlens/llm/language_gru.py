"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes in both directions and labels every byte; the probabilities of
a document are the mean over all its bytes. It is trained on the driver, in numpy, on a bounded
sample, and applied window by window to whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlens.llm.common import prepare, text_slices, whole_texts

WINDOW = 64
HIDDEN = 8
SIDE_BY_SIDE = 2048
PAD = 256
UNKNOWN = "und"
#: Bounds of the training sample, for each language.
DOCUMENTS_PER_LANGUAGE = 400
WINDOWS_PER_DOCUMENT = 4
#: Languages in one training step; all are scored in every step.
LANGUAGES_PER_STEP = 256


@dataclass
class Network:
    """Weights. Gates of one direction are stacked as reset, update, candidate."""

    labels: list[str]
    embed: np.ndarray  # direction, 3 * hidden, 257
    recur: np.ndarray  # direction, 3 * hidden, hidden
    out: np.ndarray  # labels, 2 * hidden
    bias: np.ndarray  # labels


_GATE_SLOPE = np.float32(0.2)


def _folded(embed: np.ndarray, recur: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights with the gates' slope and offset in them: a gate is then clip(x, 0, 1)."""
    embed, recur = embed.copy(), recur.copy()
    gates = slice(0, 2 * HIDDEN)
    embed[gates] = embed[gates] * _GATE_SLOPE + np.float32(0.5)
    recur[gates] *= _GATE_SLOPE
    return embed, recur


def _squash(x: np.ndarray) -> np.ndarray:
    """x (27 + x x) / (27 + 9 x x) within 3 of zero, in place: close to tanh and cheaper."""
    np.clip(x, -3, 3, out=x)
    y = x * x
    low = y * np.float32(9)
    low += np.float32(27)
    y += np.float32(27)
    x *= y
    x /= low
    return x


def _squash_slope(x: np.ndarray) -> np.ndarray:
    """The derivative of the same at x within 3 of zero."""
    y = x * x
    return (9 - y) ** 2 / (9 * (3 + y) ** 2)


def new_network(labels: list[str], seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    h = HIDDEN
    embed = rng.normal(0, 0.3, (2, 3 * h, 257)).astype(np.float32)
    recur = rng.normal(0, 0.3, (2, 3 * h, h)).astype(np.float32)
    out = rng.normal(0, 0.3, (len(labels), 2 * h)).astype(np.float32)
    return Network(labels, embed, recur, out, np.zeros(len(labels), np.float32))


def _run(embed: np.ndarray, recur: np.ndarray, x: np.ndarray, keep: bool):
    """Hidden states of one direction: x is time by windows, states time by hidden by windows."""
    steps, n = x.shape
    h = HIDDEN
    states = np.empty((steps, h, n), np.float32)
    state = np.zeros((h, n), np.float32)
    gates = np.empty((3 * h, n), np.float32)
    own = np.empty((3 * h, n), np.float32)
    trace = []
    for t in range(steps):
        np.take(embed, x[t], axis=1, out=gates, mode="clip")
        np.matmul(recur, state, out=own)
        gates[: 2 * h] += own[: 2 * h]
        raw = gates[: 2 * h].copy() if keep else None
        np.clip(gates[: 2 * h], 0, 1, out=gates[: 2 * h])
        own_candidate = own[2 * h :].copy() if keep else None
        candidate = gates[2 * h :]
        reset, update = gates[:h], gates[h : 2 * h]
        own[2 * h :] *= reset
        candidate += own[2 * h :]
        inner = candidate.clip(-3, 3) if keep else None
        _squash(candidate)
        new = states[t]
        np.subtract(state, candidate, out=new)
        new *= update
        new += candidate
        if keep:
            trace.append((state, reset.copy(), update.copy(), candidate.copy(), own_candidate, raw, inner))
        state = new
    return states, trace


def _back(embed_shape, recur, x, trace, upstream):
    """Gradients of one direction by backpropagation through time."""
    h = HIDDEN
    steps, n = x.shape
    d_embed = np.zeros(embed_shape, np.float32)
    d_recur = np.zeros_like(recur)
    d_state = np.zeros((h, n), np.float32)
    d_gates = np.empty((3 * h, n), np.float32)
    for t in range(steps - 1, -1, -1):
        before, reset, update, candidate, own, raw, inner = trace[t]
        d = d_state + upstream[t]
        d_update = d * (before - candidate)
        d_candidate = d * (1 - update) * _squash_slope(inner)
        d_reset = d_candidate * own
        inside = ((raw > 0) & (raw < 1)) * _GATE_SLOPE
        d_gates[:h] = d_reset * inside[:h]
        d_gates[h : 2 * h] = d_update * inside[h:]
        d_gates[2 * h :] = d_candidate
        hot = np.zeros((257, n), np.float32)
        hot[x[t], np.arange(n)] = 1
        d_embed += d_gates @ hot.T
        through = d_gates.copy()
        through[2 * h :] *= reset
        d_recur += through @ before.T
        d_state = d * update + recur.T @ through
    return d_embed, d_recur


def position_probabilities(net: Network, x: np.ndarray) -> np.ndarray:
    """Probabilities labels by time by windows of bytes x, time by windows."""
    ahead, _ = _run(*_folded(net.embed[0], net.recur[0]), x, False)
    behind, _ = _run(*_folded(net.embed[1], net.recur[1]), x[::-1], False)
    return _softmax(_scores(net, ahead, behind[::-1]))


def _scores(net: Network, ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Scores time by labels by windows."""
    h = HIDDEN
    scores = np.matmul(net.out[:, :h], ahead)
    scores += np.matmul(net.out[:, h:], behind)
    scores += net.bias[:, None]
    return scores


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def train(windows: np.ndarray, target: np.ndarray, labels: list[str], steps: int = 240) -> Network:
    """Fit the network to windows (n by WINDOW bytes, PAD where a text ended) and label numbers."""
    net = new_network(labels)
    rng = np.random.default_rng(11)
    h, batch = HIDDEN, 256
    by_label = [np.flatnonzero(target == k) for k in range(len(labels))]
    weights = [net.embed, net.recur, net.out, net.bias]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    # Where the languages do not fit into one step, there are more steps.
    steps *= -(-len(labels) // LANGUAGES_PER_STEP)
    for step in range(1, steps + 1):
        some = by_label
        if len(labels) > LANGUAGES_PER_STEP:
            some = [by_label[k] for k in rng.choice(len(labels), LANGUAGES_PER_STEP, replace=False)]
        # As many windows of each language, so that a common one is not preferred.
        pick = np.concatenate([rng.choice(ids, -(-batch // len(some))) for ids in some])
        x = np.ascontiguousarray(windows[pick].T)
        mask = (x != PAD).astype(np.float32)
        ahead, trace_a = _run(*_folded(net.embed[0], net.recur[0]), x, True)
        behind, trace_b = _run(*_folded(net.embed[1], net.recur[1]), x[::-1], True)
        back = behind[::-1]
        d_scores = _softmax(_scores(net, ahead, back))
        d_scores[:, target[pick], np.arange(len(pick))] -= 1
        d_scores *= (mask / max(1.0, mask.sum()))[:, None, :]
        d_out = np.concatenate(
            [np.einsum("tln,thn->lh", d_scores, s, optimize=True) for s in (ahead, back)], axis=1
        )
        up = np.matmul(net.out.T, d_scores)
        grad_a = _back(net.embed[0].shape, net.recur[0], x, trace_a, up[:, :h])
        grad_b = _back(net.embed[1].shape, net.recur[1], x[::-1], trace_b, up[::-1, h:])
        grads = [
            np.stack([grad_a[0], grad_b[0]]), np.stack([grad_a[1], grad_b[1]]), d_out,
            d_scores.sum(axis=(0, 2)),
        ]
        rate = 0.03 * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(weights, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def cut_windows(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts as windows, padded at the end of each text, and each one's text."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = offsets[row][:, None] + nth[:, None] * WINDOW + np.arange(WINDOW)[None, :]
    inside = at < offsets[row + 1][:, None]
    wide = np.append(buf, 0)
    windows = np.where(inside, wide[np.where(inside, at, 0)], PAD).astype(np.int16)
    return windows, row


def pooled(net: Network, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean probabilities of every text over its bytes, and how many bytes have each label."""
    n, k = len(offsets) - 1, len(net.labels)
    windows, row = cut_windows(buf, offsets)
    total, votes = np.zeros((n, k)), np.zeros((n, k), np.int64)
    # Fewer windows at a time where there are many labels, as each byte has a probability of each.
    side = max(1, min(SIDE_BY_SIDE, (SIDE_BY_SIDE << 4) // k))
    for low in range(0, len(row), side):
        part = slice(low, low + side)
        x = np.ascontiguousarray(windows[part].T).astype(np.intp)
        probability = position_probabilities(net, x)
        mask = x != PAD
        label = np.where(mask, probability.argmax(axis=1), -1)
        probability *= mask[:, None, :]
        summed = probability.sum(axis=0)
        for j in range(k):
            total[:, j] += np.bincount(row[part], summed[j], n)
            votes[:, j] += np.bincount(row[part], (label == j).sum(axis=0), n).astype(np.int64)
    return total / np.maximum(1, np.diff(offsets))[:, None], votes


# ---- on documents -----------------------------------------------------------------------------


def held_out():
    """Documents that training never sees; a null id is not held out, and not learned from."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


SAMPLE_PARTS = 16


def training_sample(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows spread over the texts of a sample of labelled documents, bounded for each language.

    The sample has at most DOCUMENTS_PER_LANGUAGE documents of each language, chosen by a hash of
    their ids, and of an id with several rows in a language one. Only windows of these reach the
    driver.
    """
    known = docs.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") > 0)
    ).where(~held_out())
    known = known.select("doc_id", "lang", "text", F.xxhash64("text").alias("text_hash"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # First in parts of a language, so that the last task's rows do not grow with the table.
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SAMPLE_PARTS))
    within = Window.partitionBy("lang", "part").orderBy(*order)
    chosen = (
        known.groupBy("doc_id", "lang")
        .agg(F.min("text_hash").alias("text_hash"))
        .withColumn("part", part)
        .withColumn("nth", F.row_number().over(within))
        .where(F.col("nth") <= DOCUMENTS_PER_LANGUAGE)
        .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("nth") <= DOCUMENTS_PER_LANGUAGE)
        .select("doc_id", "lang", "text_hash")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, names = batch.column(0), batch.column(1)
            for low, _, buf, offsets in text_slices(batch.column(2)):
                cut, row = cut_windows(buf, offsets)
                count = np.bincount(row, minlength=len(offsets) - 1)
                begin = np.cumsum(count) - count
                pick = []
                for r, c in enumerate(count.tolist()):
                    pick += sorted({begin[r] + c * j // WINDOWS_PER_DOCUMENT for j in range(WINDOWS_PER_DOCUMENT if c else 0)})
                pick = np.array(pick, np.int64)
                of = pa.array(row[pick] + low)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(of), names.take(of), pa.array(pick - begin[row[pick]]),
                        pa.array([w.tobytes() for w in cut[pick]], pa.binary()),
                    ],
                    ["doc_id", "lang", "nth", "bytes"],
                )

    # At most DOCUMENTS_PER_LANGUAGE ids a language: small by construction.
    texts = known.join(F.broadcast(chosen), ["doc_id", "lang", "text_hash"], "left_semi")
    rows = texts.select("doc_id", "lang", "text").mapInArrow(
        windows, f"doc_id {kind}, lang string, nth long, bytes binary"
    )
    # Repeated rows give the same windows, of which one stays.
    once = rows.groupBy("doc_id", "lang", "nth").agg(F.min("bytes").alias("bytes"))
    found = sorted((r[0], bytes(r[1])) for r in once.select("lang", "bytes").collect())
    labels = sorted({name for name, _ in found})
    number = {name: k for k, name in enumerate(labels)}
    x = np.frombuffer(b"".join(b for _, b in found), np.int16).reshape(-1, WINDOW)
    return x, np.array([number[name] for name, _ in found], np.int64), labels


def fit(docs: DataFrame) -> Network | None:
    windows, target, labels = training_sample(docs)
    return train(windows, target, labels) if labels else None


_LETTER = r"\p{L}"


def predict(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """The language of every whole text.

    Columns: ``doc_id, held_out, lang_pred, score`` and ``labelled_bytes``, how many bytes carry
    the predicted label. Without a network one is fitted to the ``lang`` of documents that are
    not held out. A text that is null, empty or without a letter is ``und`` with score 0, as are
    all if there is nothing to learn from. Rows are judged one by one, repeated ones too; an
    empty table gives no rows; further columns are ignored.
    """
    prepare(docs.sparkSession)
    net = net or fit(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = whole_texts(docs, "doc_id")
    source = rows.select(
        "doc_id", "text", held_out().alias("held_out"), F.col("text").rlike(_LETTER).alias("letters")
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column(3).to_numpy(zero_copy_only=False)
            for low, high, buf, offsets in text_slices(batch.column(1)):
                score, names, agree = np.zeros(high - low), [UNKNOWN] * (high - low), [0] * (high - low)
                if net is not None:
                    mean, votes = pooled(net, buf, offsets)
                    best = mean.argmax(axis=1)
                    for i in np.flatnonzero(letters[low:high]).tolist():
                        names[i] = net.labels[best[i]]
                        score[i] = min(1.0, float(mean[i, best[i]]))
                        agree[i] = int(votes[i, best[i]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high], batch.column(2)[low:high],
                        pa.array(names, pa.string()), pa.array(score), pa.array(agree, pa.int64()),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score", "labelled_bytes"],
                )

    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double, labelled_bytes long"
    return source.mapInArrow(judge, schema)


#: How far above 1 / labels, as a share of it, the best score of a text of a window or more must be.
MARGIN = 0.1


def undecided(best: np.ndarray, size: np.ndarray, labels: int, margin: float = MARGIN) -> np.ndarray:
    """Whether best scores are within the margin of 1 / labels, which says nothing.

    The margin follows the number of labels, and is smaller for texts of less than a window, as
    few bytes are no reason to reject. A single label leaves nothing to decide.
    """
    if labels < 2:
        return np.zeros(len(best), bool)
    return best * labels < 1 + margin * np.minimum(1, size / WINDOW)


def keep_known(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """The rows with a letter whose language is not ``undecided``, all columns as they were.

    A text that is null, empty or without a letter goes. If there is nothing to learn from, as
    no labelled row is outside the held-out ones, all rows with a letter stay.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.where(text.rlike(_LETTER))
    net = fit(docs)
    if net is None:
        return rows

    def known(texts: pa.Array) -> pa.Array:
        keep = np.zeros(len(texts), bool)
        for low, high, buf, offsets in text_slices(texts):
            best = pooled(net, buf, offsets)[0].max(axis=1)
            keep[low:high] = ~undecided(best, np.diff(offsets), len(net.labels), margin)
        return pa.array(keep)

    return rows.where(F.arrow_udf(known, "boolean")(text))
