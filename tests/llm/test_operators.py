"""Every operator against a plain definition, on nulls, empty, long, repeated and tied rows."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from rosterlens.llm import (
    bpe,
    exact_dedup,
    hilbert_neighbours,
    language_gru,
    licenses,
    packing,
    pii_crf,
    substring_dedup,
    warc,
)

# Extra columns whose names operators use themselves.
SCHEMA = "doc_id long, text string, lang string, fingerprint string, row string, cls int"


def texts():
    rng = random.Random(3)
    words = "the of and a house grün été ça va mit license apache don't we'll I've 123 4.5 -- !!".split()
    out = [" ".join(rng.choices(words, k=rng.choice([1, 3, 40, 90]))) for _ in range(40)]
    out += [
        None, "", " \t\n", "a" * 3000, "x  y\r\n z ", "It's <|endoftext|> here", "日本語 テキスト 😀",
        "mail bob.t@mail.example.com, ip 10.0.0.255 or 300.1.1.1; +1 (555) 123-4567.",
        "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "The MIT License. GNU General Public License",
        "Licensed under the Apache License, Version 2.0.\nAll rights reserved.",
    ]
    return out


def rows():
    found = [(i, t, None if i % 9 == 0 else "en" if i % 2 else "de", "f", "r", 1) for i, t in enumerate(texts())]
    return found + [found[0], found[0], (None, "no id", "en", "f", "r", 1), (None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tokenizer():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def by_id(found):
    return sorted((tuple(r) for r in found), key=str)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_bpe(docs, empty):
    enc = tokenizer()
    expected = []
    for r in rows():
        ids = enc.encode_ordinary(r[1] or "")
        expected.append((r[0], len(ids), sha(np.array(ids, "<u4").tobytes()), sha((r[1] or "").encode())))
    assert by_id(bpe.digests(docs).collect()) == by_id(expected)
    assert bpe.digests(empty).collect() == []


def test_bpe_pieces_of_any_characters():
    enc, mine = tokenizer(), bpe.Encoder(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    rng = random.Random(4)
    alphabet = list("abstrevmld'  \n\t\x1c\x85") + ["'s", "'ll", "é", "²", "1", "!", "　", "日", "  "]
    found = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]
    raw = [t.encode() for t in found]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    ids, bounds = mine.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for i, text in enumerate(found):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == enc.encode_ordinary(text), text


def test_exact_dedup(docs, empty):
    groups = defaultdict(list)
    for r in rows():
        groups[r[1] or ""].append(r[0])
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            expected.append((i, keep, len(ids), kept, sha(text.encode())))
    assert by_id(exact_dedup.duplicates(docs).collect()) == by_id(expected)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.duplicates(empty).collect() == []


def test_fingerprints_compose(spark):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 200_000).astype(np.uint8)
    whole = exact_dedup.text_hash(data)
    cut = exact_dedup.combine(exact_dedup.text_hash(data[:70_001]), exact_dedup.text_hash(data[70_001:]))
    assert cut == whole
    text = data.tobytes().decode()
    chunks = [(1, i, text[at : at + 33_333]) for i, at in enumerate(range(0, len(text), 33_333))]
    found = exact_dedup.combine_chunks(spark.createDataFrame(chunks, "d int, p int, c string"), "d", "p", "c").collect()
    assert [tuple(r) for r in found] == [(1, exact_dedup.packed(whole), len(data))]


def test_equal_fingerprints_of_different_texts_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F
    from pyspark.sql.types import LongType

    monkeypatch.setattr(exact_dedup, "fingerprint", lambda c: F.lit(1).cast(LongType()))
    docs = spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "ab"), (4, "xyz")], "doc_id long, text string")
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.duplicates(docs).collect()}
    assert found == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True), 4: (4, 1, True)}


def test_packing(docs, empty, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 5)
    found = packing.packed(docs, capacity=64, group_items=5).collect()
    enc = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for r in rows():
        ids = np.array([*enc.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, n in enumerate(packing.piece_lengths(len(ids), 64)):
            expected.append((r[0], k, at, n, zlib.crc32(ids[at : at + n].tobytes())))
            at += n
    assert by_id(tuple(r)[:5] for r in found) == by_id(expected)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    total = sum(n for *_, n, _ in expected)
    assert len(sequences) <= 1.15 * total / 64 + 2
    assert packing.packed(empty).collect() == []


def test_best_fit_leaves_one_small_bin():
    sizes = np.random.default_rng(0).integers(1, 65, 500)
    where, fills = packing.best_fit(sizes, 64)
    assert np.array_equal(np.bincount(where, sizes), fills) and fills.max() <= 64
    assert (2 * fills <= 64).sum() <= 1


def test_personal_data(docs, empty):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    found = {r["doc_id"]: r for r in pii_crf.spans_of(docs).collect() if r["doc_id"] is not None}
    for r in rows():
        if r[0] is None:
            continue
        base = pii_crf.base_spans(r[1] or "")
        assert [s[1:] for s in base if s[0] == 0] == [m.span() for m in email.finditer(r[1] or "")]
        row = found[r[0]]
        joined = ",".join(f"{pii_crf.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert row["base_sha256"] == sha(joined.encode())
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))
    special = next(r for r in rows() if r[1] and r[1].startswith("mail"))
    row = found[special[0]]
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 0, 1)
    card = next(r for r in rows() if r[1] and r[1].startswith("card"))
    assert pii_crf.base_spans(card[1]) == [(2, 5, 24)]
    clean = pii_crf.redact(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert "[EMAIL]" in clean.where(f"doc_id = {special[0]}").first()["text"]
    assert pii_crf.spans_of(empty).collect() == []


def test_redacted_texts_go_out_slice_by_slice(spark):
    long = "mail a.b@c.de now " + "word " * 40000
    table = [(1, long, 7), (2, None, 5), (3, "", 9), (4, "\u00e9 x@y.zz", 1)]
    docs = spark.createDataFrame(table, "doc_id long, text string, n_chars int").coalesce(1)
    clean = pii_crf.redact(docs)
    # A scalar function would hold a whole batch of texts on both sides.
    assert "MapInArrow" in clean._jdf.queryExecution().executedPlan().toString()
    assert clean.schema == docs.schema
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in clean.collect()}
    text = long.replace("a.b@c.de", "[EMAIL]")
    assert found == {1: (text, len(text)), 2: (None, 5), 3: ("", 0), 4: ("\u00e9 [EMAIL]", 9)}


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(2)
    size = pii_crf._TEMPLATES * (pii_crf._HASHED + 1)
    field = pii_crf.Field(
        *(rng.normal(size=s).astype(np.float32) for s in ((size, pii_crf.TAGS), (pii_crf.TAGS, pii_crf.TAGS), pii_crf.TAGS))
    )
    raw = np.frombuffer(b"a 1.2 @x\n+3 (4) B5 c-d e\n\nf", np.uint8)
    found = pii_crf.tokens(raw, np.array([0, len(raw)]))
    tags = pii_crf.viterbi(field, found)
    for line in np.unique(found.line):
        at = np.flatnonzero(found.line == line)
        scores = field.weights[found.features[at]].sum(axis=1)
        best, back = scores[0] + field.begin, []
        for s in scores[1:]:
            joint = best[:, None] + field.moves
            back.append(joint.argmax(axis=0))
            best = joint.max(axis=0) + s
        path = [int(best.argmax())]
        for b in back[::-1]:
            path.append(int(b[path[-1]]))
        assert path[::-1] == tags[at].tolist()


def plain_removal(found):
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in found]
    count = defaultdict(int)
    for w in words:
        for i in range(len(w) - 34):
            count[tuple(w[i : i + 35])] += 1
    out = []
    for r, w in zip(found, words):
        gone = {p for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for p in range(i, i + 35)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((r[0], len(w), len(gone), sha(kept.encode())))
    return by_id(out)


@pytest.mark.parametrize("least", [4096, 1])
def test_substring_dedup(spark, empty, monkeypatch, least):
    monkeypatch.setattr(substring_dedup, "FREQUENT_LEAST", least)
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (34, 35, 36, 80)]
    found = list(rows())
    for i in range(60):
        parts = [rng.choices(vocabulary, k=rng.randint(0, 50)) for _ in range(3)] + rng.sample(passages, rng.randint(0, 2))
        rng.shuffle(parts)
        found.append((100 + i, "  ".join(w for p in parts for w in p), "en", "f", "r", 1))
    found.append((500, " ".join(["same"] * 200), "en", "f", "r", 1))
    docs = spark.createDataFrame(found, SCHEMA).repartition(4)
    assert by_id(substring_dedup.digests(docs).collect()) == plain_removal(found)
    if least == 1:
        assert substring_dedup.digests(empty).collect() == []


def test_licenses(docs, empty):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    found = {r["doc_id"]: r for r in licenses.scan(docs).collect() if r["doc_id"] is not None}
    for r in rows():
        if r[0] is None:
            continue
        low = (r[1] or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = sorted(
            (i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()
        )
        row = found[r[0]]
        labels = sorted({label for _, label in places})
        assert (row["n_words"], row["n_base"], row["base_labels"]) == (len(words), len(places), ",".join(labels))
        assert (row["first_word"], row["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert set(labels) <= set(filter(None, row["labels"].split(","))) and 0 <= row["score"] <= 1
    notice = next(r[0] for r in rows() if r[1] and r[1].startswith("Licensed"))
    assert found[notice]["labels"] == "all-rights-reserved,apache"
    assert licenses.scan(empty).collect() == []


def test_language(spark, docs, empty):
    rng = random.Random(8)
    sound = {"de": ["und", "der", "schön", "nicht", "größe", "zeit"], "en": ["the", "and", "with", "thing", "other", "shed"]}
    found = [(i, " ".join(rng.choices(sound[lang], k=60)), lang) for i in range(400) for lang in [rng.choice(["de", "en"])]]
    found += [(1000, None, "de"), (1001, "", "en"), (1002, "12 !!", "en"), (None, "the thing", None)]
    table = spark.createDataFrame(found, "doc_id long, text string, lang string")
    rows_ = {r["doc_id"]: r for r in language_gru.predict(table).collect()}
    held = [f for f in found[:400] if rows_[f[0]]["held_out"]]
    assert held and all(rows_[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in found[:400])
    assert sum(rows_[i]["lang_pred"] == lang for i, _, lang in held) >= 0.95 * len(held)
    assert {rows_[i]["lang_pred"] for i in (1000, 1001, 1002)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in rows_.values())
    assert language_gru.predict(empty).collect() == []


def test_every_language_is_learned(spark):
    rng = random.Random(2)
    # Each of 70 languages is written in letters of its own.
    found = [(i, " ".join(chr(0x4E00 + 40 * (i % 70) + rng.randrange(3)) * 3 for _ in range(20)), f"l{i % 70:02}") for i in range(1400)]
    table = spark.createDataFrame(found, "doc_id long, text string, lang string")
    assert language_gru.training_sample(table)[2] == sorted({f[2] for f in found})


def test_repeated_ids_count_once_in_the_sample(spark):
    found = [(1, "the thing and the other " * 20, "en")] * 500 + [(1, f"another text {i} " * 20, "en") for i in range(50)]
    found += [(1, "das Ding und das andere " * 20, "de"), (3, "and with the shed " * 20, "en"), (4, "", "en")]
    assert all(zlib.crc32(str(f[0]).encode()) % 4 != 2 for f in found)
    table = spark.createDataFrame(found, "doc_id long, text string, lang string").repartition(5)
    windows, target, labels = language_gru.training_sample(table)
    assert labels == ["de", "en"] and np.bincount(target).tolist() == [4, 8]


def test_more_languages_than_fit_into_a_step(monkeypatch):
    monkeypatch.setattr(language_gru, "LANGUAGES_PER_STEP", 2)
    windows = np.repeat(np.arange(97, 102, dtype=np.int16)[:, None], 64, axis=1)
    net = language_gru.train(windows, np.arange(5), list("abcde"), steps=60)
    raw = np.ascontiguousarray(windows.astype(np.uint8).ravel())
    assert language_gru.pooled(net, raw, np.arange(6) * 64)[0].argmax(axis=1).tolist() == [0, 1, 2, 3, 4]


def test_known_languages_stay(spark, docs, monkeypatch):
    def kept(table):
        return by_id(language_gru.keep_known(table).collect())

    letters = by_id(r for r in rows() if any(c.isalpha() for c in r[1] or ""))
    # Nothing to learn from: no label, and labelled rows that are all held out.
    assert kept(docs.selectExpr("doc_id", "text", "CAST(NULL AS string) lang", "fingerprint", "row", "cls")) == by_id(
        (r[0], r[1], None, *r[3:]) for r in letters
    )
    held = [r[0] for r in rows() if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert held and kept(docs.where(docs.doc_id.isin(held))) == by_id(r for r in letters if r[0] in held)
    # Of many languages none reaches a fixed share, but one stands out.
    net = language_gru.new_network([f"l{i:02}" for i in range(40)])
    monkeypatch.setattr(language_gru, "fit", lambda table: net)
    scores = [r["score"] for r in language_gru.predict(docs, net).where("lang_pred != 'und'").collect()]
    assert max(scores) < 0.4 and min(scores) > 1.1 / 40
    assert kept(docs) == letters
    # A network that has no preference rejects.
    net.out[:] = 0
    assert kept(docs) == []


def test_margin_follows_labels_and_length():
    best, size = np.array([0.27, 0.28, 0.253, 0.251]), np.array([64, 64, 2, 2])
    assert language_gru.undecided(best, size, 4).tolist() == [True, False, False, False]
    assert not language_gru.undecided(best, size, 40).any()
    assert not language_gru.undecided(np.ones(1), np.array([500]), 1).any()


def test_warc(spark):
    found = [(5, "http://b.org/x", "<p>é</p>"), (2, "http://a.org/", "<p>é</p>"), (9, "http://a.org/", "<p>é</p>"), (3, None, None),
             (4, "u\r\nWARC/1.1", ""), (7, "http://a.org:80/?q=1", "WARC/1.1\r\n\r\nContent-Length: 3\r\n"), (None, "http://c", "own")]
    pages = spark.createDataFrame([(*r, "x") for r in found], "page_id long, url string, html string, run string")
    index = warc.capture_index(pages).collect()
    first = {}
    for page, _, html in sorted(found, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", page)
    expected = []
    for page, _, html in found:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = first[html or ""] != page
        expected.append((page, len(raw), digest, "revisit" if again else "response", first[html or ""] if again else None))
    assert by_id(tuple(r)[:5] for r in index) == by_id(expected)
    order = sorted(index, key=lambda r: (r["range_no"], r["place_in_range"]))
    keys = [warc.sort_key(r["url_key"], r["captured"], r["page_id"]) for r in order]
    assert keys == sorted(keys)
    assert warc.capture_index(pages.where("page_id < 0")).collect() == []


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7):
        runs = [sorted(rng.choices(range(50), k=rng.randint(0, 30))) for _ in range(k)]
        merged = [x for x, _ in warc.LoserTree([iter([(x, i) for x in r]) for i, r in enumerate(runs)])]
        assert merged == sorted(x for r in runs for x in r)


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(300, 16)).astype(np.float32)
    vectors[40:90] = vectors[0]
    found = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(300, None), (350, [0.0] * 16), (351, [float("nan")] * 16), (352, [1.0, None]), (None, vectors[1].tolist()), found[5]]
    table = spark.createDataFrame([(*f, "x") for f in found + bad], "vec_id long, embedding array<float>, v string")
    out = hilbert_neighbours.neighbours(table).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append(r["vec_id"])
    wide = vectors.astype(np.float64)
    for q in range(0, 300, 50):
        score = wide @ wide[q] / (np.sqrt((wide**2).sum(1)) * np.sqrt((wide[q] ** 2).sum()))
        score[q] = -9
        assert got[q] == np.lexsort((np.arange(300), -score.round(12)))[:5].tolist()
    assert hilbert_neighbours.neighbours(table.where("vec_id < 0")).collect() == []


def test_license_matches_of_a_long_file_take_time_in_proportion():
    index = licenses.build_index({}, 10)
    phrase = licenses._hashes("this work is licensed under the mit license".split())
    found = {}
    for repeats in (1, 4000):
        begin = time.process_time()
        matched = licenses._matches(index, index.numbers(np.tile(phrase, repeats)))
        found[repeats] = matched, time.process_time() - begin
    assert found[1][0].keys() <= found[4000][0].keys()
    assert found[4000][1] < 15


def test_spans_of_the_field_have_the_form_of_their_kind():
    kinds = {k: i for i, k in enumerate(pii_crf.KINDS)}
    good = [("email", "me@localhost"), ("ip", "10.0.0.1"), ("card", "378282246310005"), ("phone", "(030) 123-4567")]
    bad = [("email", "4.0"), ("ip", "4.0"), ("card", "1234567812345678"), ("phone", "2024")]
    assert all(pii_crf._plausible(kinds[k], text) for k, text in good)
    assert not any(pii_crf._plausible(kinds[k], text) for k, text in bad)
