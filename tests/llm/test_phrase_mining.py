"""Collocations against plain counting, whatever the shards, slots and slices."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from test_operators import SCHEMA, rows

from rosterlens.llm import phrase_mining


def phrases_of(found, most_words):
    counts, totals = defaultdict(Counter), Counter()
    for r in found:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[r[2] or "und"] += len(words)
            for n in range(1, most_words + 1):
                for i in range(len(words) - n + 1):
                    counts[r[2] or "und"][tuple(words[i : i + n])] += 1
    return counts, totals


def plain(found, most_words=3, least=10, top=2000):
    out = []
    counts, totals = phrases_of(found, most_words)
    for lang, f in counts.items():
        candidates = {p for p in f if len(p) > 1 and f[p] >= least}
        kept = []
        for p in candidates:
            inside = (
                len(q) > len(p) and 100 * f[q] >= 50 * f[p] and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q in candidates
            )
            if not any(inside):
                a = f[p]
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def table():
    """The shared rows, and texts in which phrases, some within longer ones, come again."""
    rng = random.Random(6)
    found = [tuple(r) for r in rows()]
    words = [f"w{i}" for i in range(25)] + ["É", "x'y", "A-b", "ü\x00"]
    fixed = ["new york city", "New  York", "york\tcity hall", "one two three four", "is it so", "the of the of the"]
    for i in range(300):
        parts = rng.choices(words, k=rng.randint(0, 9)) + rng.choices(fixed, k=rng.randint(0, 3))
        rng.shuffle(parts)
        text = "".join(p + rng.choice([" ", " ", " ", "  ", ". ", ",", "\n", "\r\n"]) for p in parts)
        found.append((100 + i, text, rng.choice(["en", "en", "de", None]), "f", "r", 1))
    return found + found[-20:]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(table(), SCHEMA).repartition(3).cache()


@pytest.mark.parametrize(
    "most_words,least,top,shards,slots",
    [(3, 10, 2000, 4, 1 << 24), (3, 10, 7, 3, 64), (4, 4, 2000, 2, 1 << 12)],
)
def test_collocations_equal_plain_counting(docs, most_words, least, top, shards, slots):
    found = phrase_mining.collocations(docs, most_words, least, top, shards, slots)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == plain(table(), most_words, least, top)


def test_nothing_to_count(spark):
    assert phrase_mining.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    only_empty = spark.createDataFrame([(1, None, "en", "f", "r", 1), (2, " \t", None, "f", "r", 1)], SCHEMA)
    assert phrase_mining.collocations(only_empty).collect() == []


def test_scores_are_exact(spark):
    a, left, right = 3 * 10**15 + 1, 4 * 10**15 + 7, 10**16 - 3
    row = spark.range(1).selectExpr(f"{a}L AS a", f"{left}L AS l", f"{right}L AS r").select(phrase_mining._score().alias("s"))
    assert row.first()["s"] == 1_000_000 * a * a // (left * right)


def test_a_long_text_is_cut_between_its_pieces(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice(["ab ", "c, ", "dé ", "f.", "g "]) for _ in range(4000)) + "no break " * 300
    column = pa.array(["short one", text, ""])
    monkeypatch.setattr(phrase_mining, "SLICE_BYTES", 256)
    parts = list(phrase_mining._parts(column))
    assert b"".join(bytes(buf) for low, buf, _ in parts if low == 1) == text.encode()
    cuts = [bytes(buf) for low, buf, _ in parts if low == 1]
    assert len(cuts) > 20 and all(c[:1] in b",." for c in cuts[1:])
    # Every text is in one slice of its own rows only.
    assert [low for low, _, offsets in parts for _ in np.diff(offsets)].count(0) == 1


def test_complete_counts_below_the_threshold_are_not_written(docs, monkeypatch):
    """They are final and nothing asks for them; all others are kept."""
    written, write = [], phrase_mining._written

    def kept(table, *parts):
        written.append(write(table, *parts))
        return written[-1]

    monkeypatch.setattr(phrase_mining, "_written", kept)
    phrase_mining.count_phrases(docs)
    steps = [t for t in written if "complete" in t.columns]
    assert sum(t.where("complete and not frequent").count() for t in steps) == 0
    assert sum(t.where("not complete and not frequent").count() for t in steps) > 0


def test_ranges_of_a_buffer():
    buf = np.frombuffer(b"abcdefgh", np.uint8)
    starts, ends = np.array([0, 3, 3, 7, 1]), np.array([2, 3, 6, 8, 8])
    assert phrase_mining._strings(buf, starts, ends).to_pylist() == ["ab", "", "def", "h", "bcdefgh"]
    none = np.zeros(2, np.int64)
    assert phrase_mining._strings(buf, none, none).to_pylist() == ["", ""]
    text, at = phrase_mining._joined(buf, np.array([0, 3, 7]), np.array([2, 6, 8]))
    assert text.tobytes() == b"ab def h " and at.tolist() == [0, 3, 7]
