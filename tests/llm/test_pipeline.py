"""Every stage of the pipeline on its own input, and all in a row, against plain versions."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from test_jaccard_join import brute
from test_operators import SCHEMA, by_id, rows
from tokenizers import Tokenizer

import corpus_pipeline
from rosterlens.llm import language_gru, pii_crf


def best_score(net, raw):
    """The mean probability of the best language, one byte at a time."""
    h, total = language_gru.HIDDEN, np.zeros(len(net.labels))

    def states(embed, recur, window):
        state, out = np.zeros(h), []
        for byte in window:
            x, own = embed[:, byte], recur @ state
            reset, update = np.clip(0.2 * (x[: 2 * h] + own[: 2 * h]) + 0.5, 0, 1).reshape(2, h)
            inner = np.clip(x[2 * h :] + reset * own[2 * h :], -3, 3)
            new = inner * (27 + inner**2) / (27 + 9 * inner**2)
            state = update * state + (1 - update) * new
            out.append(state)
        return out

    for low in range(0, len(raw), 64):
        part = list(raw[low : low + 64])
        window = part + [256] * (64 - len(part))
        ahead = states(net.embed[0], net.recur[0], window)
        behind = states(net.embed[1], net.recur[1], window[::-1])[::-1]
        for a, b, _ in zip(ahead, behind, part):
            e = np.exp(net.out @ np.concatenate([a, b]) + net.bias)
            total += e / e.sum()
    return total.max() / len(raw)


def language_id(found, table):
    net, out = language_gru.fit(table), []
    for r in found:
        raw = (r[1] or "").encode()
        if any(c.isalpha() for c in r[1] or ""):
            if best_score(net, raw) >= (1 + 0.1 * min(1, len(raw) / 64)) / len(net.labels):
                out.append(r)
    return out


def exact_duplicates(found, table):
    groups = defaultdict(list)
    for r in found:
        groups[r[1] or ""].append(r)
    return [max(g, key=lambda r: (r[0] is not None, r[0] or 0)) for g in groups.values()]


def near_duplicates(found, table):
    stay = {i for i, n, component in brute(found) if n == 0 or i == component}
    return [r for r in found if r[0] in stay]


def personal_data(found, table):
    field, out = pii_crf.fit(pii_crf.labelled_table(table)), []
    for r in found:
        raw, merged = np.frombuffer((r[1] or "").encode(), np.uint8), []
        base, spans = pii_crf.find_spans(field, raw, np.array([0, len(raw)]))[0]
        assert base == pii_crf.base_spans(r[1] or "") and set(base) <= set(spans)
        for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
            if merged and start < merged[-1][2]:
                merged[-1][2] = max(merged[-1][2], end)
            else:
                merged.append([kind, start, end])
        text = r[1]
        for kind, start, end in reversed(merged):
            text = f"{text[:start]}[{pii_crf.KINDS[kind].upper()}]{text[end:]}"
        out.append((r[0], text, *r[2:]))
    return out


def pieces(found):
    enc, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    for r in found:
        ids = np.array([*enc.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            out.append((r[0], k, at, len(part), zlib.crc32(part.tobytes())))
    return by_id(out)


def check_packed(packed, found):
    assert by_id(tuple(r)[:5] for r in packed) == pieces(found)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [at for at, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


def test_stages_and_run(spark, tmp_path):
    base = " ".join(f"w{i}" for i in range(60))
    found = rows() + [(200, base, "en", "f", "r", 1), (201, re.sub("w30 ", "", base), "de", "f", "r", 1)]
    found += [(203, base, "en", "f", "r", 1), (202, "12 -- !!", "en", "f", "r", 1)]
    spark.createDataFrame(found, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    plain = [language_id, exact_duplicates, near_duplicates, personal_data]
    assert [name for name, _ in corpus_pipeline.STAGES] == [*(p.__name__ for p in plain), "pack"]
    # Each stage also sees what stages before it drop: nulls, empty and repeated rows.
    whole = spark.createDataFrame(found, SCHEMA).repartition(3).cache()
    distinct = spark.createDataFrame(exact_duplicates(found, None), SCHEMA).cache()
    for (name, stage), version in zip(corpus_pipeline.STAGES, plain):
        table = distinct if name == "near_duplicates" else whole
        got = stage(spark, table, str(tmp_path))
        assert got.columns == whole.columns
        assert by_id(got.collect()) == by_id(version([tuple(r) for r in table.collect()], table)), name
    check_packed(corpus_pipeline.STAGES[-1][1](spark, whole, str(tmp_path)).collect(), found)
    for version in plain:
        found = version(found, spark.createDataFrame(found, SCHEMA))
    check_packed(corpus_pipeline.run(spark, str(tmp_path)).collect(), found)


def test_workers_return_memory_after_a_batch():
    """What a worker has freed does not stay with it until the next stage."""
    import subprocess
    import sys

    code = """
import numpy as np, pyarrow as pa
from rosterlens.llm.common import text_slices
def rss():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 / 1e6
held = [np.ones(12000) for _ in range(3000)]
last = np.ones(12000)  # the end of the heap stays in use
held = None
before = rss()
assert [s[:2] for s in text_slices(pa.array(["a", "b"]))] == [(0, 2)]
assert before - rss() > 100, (before, rss())
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=60)
