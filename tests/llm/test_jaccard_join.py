"""Near duplicates against all pairs, with frequent and long columns made to occur."""

from __future__ import annotations

import itertools
import random

import pytest

from rosterlens.llm import jaccard_join

SCHEMA = "doc_id long, text string, cls string, h long"


def brute(rows):
    def shingles(text):
        words = (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})).split()
        if len(words) < 5:
            return frozenset([tuple(words)] if words else [])
        return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))

    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), min(ids, default=None) if sets[i] else r[0]))
    return sorted(out, key=str)


def documents(seed=5):
    """Passages that many texts share, near copies of one text, tiny and empty texts, nulls."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(words) for _ in range(14)] for _ in range(4)]
    base = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(" ".join(copy))
    for _ in range(120):
        parts = rng.sample(passages, rng.choice([1, 1, 2, 3])) + [
            [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 4, 40]))]
        ]
        rng.shuffle(parts)
        texts.append("  ".join(w.upper() if rng.random() < 0.1 else w for p in parts for w in p))
    texts += ["one", "ONE", "two words", "", None, " \t ", "é x", "one"]
    rows = [(i + 1, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [rows[0], (None, base and " ".join(base)), (None, None), (7, "another text under an id that exists")]
    return [(*r, "x", 1) for r in rows]


@pytest.mark.parametrize("least,most", [(24, 1 << 17), (2, 1 << 17), (2, 0)])
def test_components_equal_all_pairs(spark, monkeypatch, least, most):
    monkeypatch.setattr(jaccard_join, "FREQUENT_LEAST", least)
    monkeypatch.setattr(jaccard_join, "FREQUENT", most)
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = [tuple(r) for r in jaccard_join.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == brute(rows)


def test_one_row_of_each_component_stays(spark):
    rows = documents(9)
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    expected = brute(rows)
    with_shingle = {c for _, n, c in expected if n}
    bare = sum(n == 0 for _, n, _ in expected)
    found = kept.collect()
    assert len(found) == len(with_shingle) + bare
    assert {r["doc_id"] for r in found} >= {c for c in with_shingle if c is not None}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert jaccard_join.near_duplicates(docs).collect() == []
    assert jaccard_join.keep_one(docs).collect() == []


def test_signatures_bound_the_overlap_from_above():
    import numpy as np

    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, n)) for n in (1, 5, 60, 60, 400, 2500)] + [np.zeros(0, np.uint64)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    bits = jaccard_join.signatures(np.concatenate(sets), bounds).view(np.uint64)
    assert bits.shape == (len(sets), jaccard_join.SIGNATURE)
    for (i, a), (j, b) in itertools.product(enumerate(sets), repeat=2):
        lacking = sum(int(x).bit_count() for x in bits[i] & ~bits[j])
        assert len(np.intersect1d(a, b)) <= len(a) - lacking


def test_a_text_of_each_class_is_sent_once(spark):
    """What is sent for comparisons are texts, not sets, and one of each class asked for."""
    from pyspark.sql import functions as F

    rows = [(1, "A b c d e f"), (1, "A b c d e f"), (2, "a  b c d e f"), (3, "u v w x y z"), (None, "g h i j k l")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows * 50], SCHEMA).repartition(3)
    one = F.min(F.struct("doc_id", F.xxhash64("text").alias("text_hash"))).alias("one")
    needed = docs.where("doc_id is null or doc_id < 3").groupBy("doc_id", "text").agg(one).select("one.*")
    sent = jaccard_join._texts_of(docs, needed)
    assert sent.columns == ["cls", "text"]
    found = [r["text"].lower().split() for r in sent.collect()]
    assert sorted(found) == [["a", "b", "c", "d", "e", "f"], ["g", "h", "i", "j", "k", "l"]]


def test_pairs_of_texts_are_compared_whole():
    import numpy as np
    import pyarrow as pa

    words = [f"w{i}" for i in range(1005)]
    left = [words[:104], words, words[:9], words]
    right = [words[4:104], words[100:], words[:8] + ["Z"], words]
    texts = [pa.array([" ".join(w) for w in side]) for side in (left, right)]
    every = jaccard_join.shingle_sets(np.frombuffer(" ".join(words).encode(), np.uint8), np.array([0, len(" ".join(words))]))[0]
    assert jaccard_join.similar(*texts, np.zeros(0, np.uint64)).tolist() == [1, 1, 0, 1]
    assert jaccard_join.similar(*texts, every).tolist() == [2, 2, 0, 2]


def _entries(sets, blocks):
    """The packed entries of sets of hashes, by block, as the product gets them."""
    import numpy as np

    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = {}
    found = np.concatenate([np.sort(np.array(s, np.uint64)) for s in sets])
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    keys, size = jaccard_join.set_keys(found, bounds), np.diff(bounds)
    column, place, prev, picked, row = jaccard_join._chained(found, *(x for x in jaccard_join.prefix(found, bounds, *none)[::2]))
    e = np.empty(len(picked), jaccard_join._ENTRY)
    e["low"], e["high"] = jaccard_join._halves(column)
    e["prev_low"], e["prev_high"] = jaccard_join._halves(prev)
    e["place"], e["n"], e["cls"] = place, size[row], keys[row]
    for b in range(blocks):
        out[b] = e[jaccard_join.mix(column) % np.uint64(blocks) == b]
    return keys.tolist(), out


@pytest.mark.parametrize("spread", [1, 1 << 20, 1 << 40])
def test_product_finds_every_similar_pair_and_near_copies_in_few_blocks(spread):
    """``spread`` 1 puts many shingles in one column, which must not lose a pair."""
    rng = random.Random(11)
    base = [rng.randrange(1 << 22) * spread for _ in range(400)]
    sets = [set(base) - set(rng.sample(base, 4)) | {rng.randrange(1 << 22) * spread for _ in range(4)} for _ in range(12)]
    sets += [{rng.randrange(1 << 22) * spread for _ in range(300)} | set(base[:40]) for _ in range(12)]
    keys, blocks = _entries([sorted(s) for s in sets], 64)
    given = []
    for entries in blocks.values():
        for table in jaccard_join._multiply(entries):
            given += [frozenset(p) for p, n in zip(zip(*table.select(["a", "b"]).to_pydict().values()), table["n_b"].to_pylist()) if n]
    similar = {
        frozenset((keys[i], keys[j]))
        for i, j in itertools.combinations(range(len(sets)), 2)
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    }
    assert len(similar) == 66 and similar <= set(given)
    # Each of these pairs shares some 95 of its first entries, so it was given in most of the 64 blocks.
    assert sum(p in similar for p in given) < 8 * len(similar)


def test_leaders_are_the_rows_nearest_to_what_is_copied(spark):
    """A column's rows are compared with the one that is frequent shingles all through, whatever its class."""
    rows = [(7, 0, None, cls, cls, 100, rest) for cls, rest in [(1, 88), (2, 93), (3, 100), (4, 90)]]
    entries = spark.createDataFrame(rows, "h long, place int, before long, kind long, cls long, n int, rest int")
    pairs = {tuple(r) for r in jaccard_join._leader_pairs(entries).collect()}
    assert pairs == {(1, 3), (2, 3), (3, 4)}


def test_rows_of_one_component_do_not_meet_again(spark):
    """Of 200 copies in one component and a row outside, the pairs with that row only are made."""
    rows = [(h, h, h - 1 if h else None, c, c, 100 + c % 3, 100, -1) for c in range(200) for h in range(3)]
    rows += [(h, h, h - 1 if h else None, 900, 900, 100, 100, 900) for h in range(3)]
    schema = "h long, place int, before long, kind long, cls long, n int, rest int, root long"
    pairs = {tuple(r) for r in jaccard_join._across(spark.createDataFrame(rows, schema)).collect()}
    assert pairs == {(c, 900) for c in range(200)}
