"""The transformation against a plain definition, and the rank index against the offsets it was fitted to."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import SCHEMA, by_id, rows

from rosterlens.llm import fill_in_middle as fim


def plain(doc_id, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    p, m, s = ("".join(part) for part in (tokens[:a], tokens[a:b], tokens[b:]))
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def table():
    """The shared rows, marks in texts, and parts that end like the beginning of a mark."""
    rng = random.Random(1)
    found = [r[:2] for r in rows()]
    for i in range(200, 400):
        found.append((i, "".join(rng.choices(["a", "Bc", "<", "S", ">", "<P", "é", "😀", " ", "1", "\n"], k=rng.randint(0, 60)))))
    found += [(-5, "a <M> b"), (2**62, "word " * 50), (7, "é" * 500), (8, "<" * 300)]
    return found


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "en", "f", "r", 1) for r in table()], SCHEMA).repartition(3).cache()


def test_outputs_equal_the_definition(docs):
    found = fim.transformed(docs).collect()
    assert by_id(found) == by_id(plain(*r) for r in table())
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_texts_come_back_from_outputs(docs, spark):
    found = fim.transformed(docs).select("doc_id", fim.restored(F.col("output"), F.col("form")))
    assert by_id(found.collect()) == by_id((i, t or "") for i, t in table())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = [(*plain(*r)[:5], sha(plain(*r)[5]), sha(r[1] or "")) for r in table()]
    assert by_id(fim.digests(docs).collect()) == by_id(expected)
    assert fim.digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_index_is_exact_and_its_error_bounded():
    rng = np.random.default_rng(2)
    for steps in (np.ones(5000, int), rng.integers(1, 12, 5000), 1 + 40 * (rng.random(5000) < 0.02), rng.integers(1, 4000, 700)):
        offsets = np.concatenate([[0], np.cumsum(steps)])
        index = fim.fit(offsets)
        assert (index.lookup(np.arange(len(offsets))) == offsets).all()
        assert np.abs(index.residual.astype(int)).max(initial=0) <= fim.ERROR
    assert len(fim.fit(np.arange(100_000) * 3).rank) == 1


@pytest.mark.parametrize("block", [1, 7, 64])
def test_blocks_within_a_text_do_not_matter(monkeypatch, block):
    texts = ["", "ab1c éé", "", "xyz" * 9, " ", "😀a", "", ""]
    raw = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0] + [len(r) for r in raw])
    monkeypatch.setattr(fim, "BLOCK_BYTES", block)
    index, first = fim.token_index(buf, offsets)
    sizes = [len(re.findall("[A-Za-z]+|[^A-Za-z]", t)) for t in texts]
    assert np.diff(first).tolist() == sizes
    starts = [o + len(t[: m.start()].encode()) for o, t in zip(offsets, texts) for m in re.finditer("[A-Za-z]+|[^A-Za-z]", t)]
    assert index.lookup(np.arange(len(starts) + 1)).tolist() == [*starts, len(buf)]


def test_a_text_of_twenty_megabytes(spark):
    text = "some words, été 12 " * 1_000_000
    docs = spark.range(1).select(F.lit(4).cast("long").alias("doc_id"), F.expr("repeat('some words, été 12 ', 1000000)").alias("text"))
    row = fim.digests(docs).first()
    expected = plain(4, text)
    assert tuple(row)[:5] == expected[:5]
    assert row["output_sha256"] == hashlib.sha256(expected[5].encode()).hexdigest()
    assert row["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()
