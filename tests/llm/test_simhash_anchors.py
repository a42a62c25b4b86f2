"""SimHash components against all pairs, and the covering code against its definition."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import xxhash
from test_operators import SCHEMA, by_id, rows

from rosterlens.llm import simhash_anchors as anchors


def simhash(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    runs = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(found):
    """Rows of (doc_id, text) to (doc_id, fingerprint, component)."""
    marks = [simhash(t) for _, t in found]
    parent = {m: m for m in marks}

    def find(m):
        while parent[m] != m:
            m = parent[m]
        return m

    for a, b in itertools.combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= 2:
            parent[find(a)] = find(b)
    least: dict[int, int] = {}
    for (i, _), m in zip(found, marks):
        if i is not None:
            least[find(m)] = min(i, least.get(find(m), i))
    return [(i, f"{m:016x}", least.get(find(m))) for (i, _), m in zip(found, marks)]


def table():
    """The shared rows, near copies of long texts, and chains of copies with one more change each."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    found = [r[:2] for r in rows()]
    for group in range(4):
        text = rng.choices(words, k=120)
        for i in range(60):
            copy = list(text)
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if i % 10 == 0:
                text = copy
            found.append((1000 + 100 * group + i, " ".join(w.upper() if rng.random() < 0.1 else w for w in copy)))
    return found + [found[-1], (None, found[-1][1]), (-3, "One  two"), (-4, "one\ttwo"), (-5, "\n")]


@pytest.mark.parametrize("crowd,rows_held", [(1 << 17, 1 << 16), (1 << 17, 8), (4, 8)])
def test_components_equal_all_pairs(spark, monkeypatch, crowd, rows_held):
    monkeypatch.setattr(anchors, "CROWD", crowd)
    monkeypatch.setattr(anchors, "ROWS", rows_held)
    docs = spark.createDataFrame([(*r, "en", "f", "r", 1) for r in table()], SCHEMA).repartition(3)
    found = anchors.near_duplicates(docs).collect()
    expected = brute(table())
    assert by_id(found) == by_id(expected)
    assert len({c for _, m, c in expected}) < len({m for _, m, _ in expected})


def test_an_empty_table(spark):
    assert anchors.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_blocks_of_a_text_do_not_matter(monkeypatch):
    rng = random.Random(2)
    for size in (0, 1, 2, 3, 50):
        text = " ".join(rng.choices(["aa", "B", "é", "cccccc"], k=size)) + rng.choice(["", " \n"])
        raw = np.frombuffer(text.encode(), np.uint8)
        for block in (1, 5, 1 << 20):
            monkeypatch.setattr(anchors, "TEXT_BLOCK", block)
            assert anchors.fingerprint(raw) == simhash(text), (text, block)


def test_every_value_of_a_block_is_near_one_word():
    values = np.arange(128, dtype=np.uint64)
    words = sorted({int(v) for v in values if all(anchors.homes(np.array([v ^ np.uint64(1 << b)]))[0] == anchors.homes(np.array([v]))[0] for b in range(7))})
    assert len(words) == 16
    for v in values:
        assert sum((int(v) ^ w).bit_count() <= 1 for w in words) == 1


def test_anchors_within_radius_and_threshold_are_all_reached():
    """Against the homes of everything that differs in at most two bits."""
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    changes = np.unique(np.concatenate([[np.uint64(0)], one, (one[:, None] ^ one).ravel()]))
    owner, reached = anchors.reach(values)
    for i, value in enumerate(values):
        mine = reached[owner == i]
        assert len(mine) == len(set(mine.tolist()))
        assert set(anchors.homes(value ^ changes).tolist()) == set(mine.tolist())
