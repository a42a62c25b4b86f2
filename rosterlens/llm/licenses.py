"""License scans by a positional index of rare licence words.

Every template's words are postings: word, template, position. The words of a template that the
fewest documents have are its rare words. In a file, each occurrence of a rare word votes for the
place at which the template would start; places on which enough rare words agree are candidates,
and there the template's key phrases have to stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlens.llm.common import (
    LOWER,
    byte_class,
    prepare,
    rows_of,
    spans,
    text_slices,
    whole_texts,
    word_hashes,
)

# Words: after lower-casing, digits, a to z and everything beyond ASCII.
LICENSE_WORD = byte_class(others=bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

# Base phrases and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Label, wording, and the phrases without which a match does not count. Square
# brackets stand for words that may be anything.
TEMPLATES: list[tuple[str, str, list[str]]] = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction",
        ["permission is hereby granted", "to deal in the software without restriction"],
    ),
    ("mit", "this work is licensed under the mit license", ["mit license"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except "
        "in compliance with the license",
        ["apache license version 2 0", "except in compliance with the license"],
    ),
    (
        "gpl",
        "this work is licensed under the gnu general public license version 3",
        ["gnu general public license"],
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation",
        ["gnu general public license", "free software foundation"],
    ),
    (
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public "
        "license as published by the free software foundation",
        ["lesser general public license"],
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without "
        "fee is hereby granted",
        ["permission to use copy modify", "with or without fee is hereby granted"],
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ["mozilla public license"],
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4 0"]),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ["creative commons attribution 4 0"],
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ["unencumbered software released into the public domain"],
    ),
    ("all-rights-reserved", "all rights reserved", ["all rights reserved"]),
]

RARE_WORDS = 6
SLACK = 2
LEAST_SHARE = 0.6


def _hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)


@dataclass
class Index:
    """Templates as word numbers; the vocabulary is sorted by word hash."""

    labels: list[str]
    words: list[np.ndarray]
    phrases: list[list[tuple[int, np.ndarray]]]  # place in the template, words
    rare: list[np.ndarray]
    vocabulary: np.ndarray
    base: list[tuple[str, np.ndarray]]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The vocabulary number of every word, or -1."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)


def vocabulary() -> list[str]:
    texts = [t[1] for t in TEMPLATES] + [p for t in TEMPLATES for p in t[2]] + [*BASE_PHRASES]
    return sorted({w for t in texts for w in t.split()})


def build_index(frequency: dict[str, int], documents: int) -> Index:
    """The index for document frequencies of the vocabulary; rare words have the highest IDF."""
    names = vocabulary()
    hashes = _hashes(names)
    order = np.argsort(hashes)
    number = {names[o]: i for i, o in enumerate(order.tolist())}
    idf = {w: np.log((documents + 1) / (frequency.get(w, 0) + 1)) for w in names}
    words, phrases, rare = [], [], []
    for _, text, keys in TEMPLATES:
        split = text.split()
        words.append(np.array([number[w] for w in split]))
        top = sorted(set(split), key=lambda w: (-idf[w], w))[:RARE_WORDS]
        rare.append(np.array([number[w] for w in top]))
        found = []
        for key in map(str.split, keys):
            place = next(i for i in range(len(split)) if split[i : i + len(key)] == key)
            found.append((place, np.array([number[w] for w in key])))
        phrases.append(found)
    base = [(label, np.array([number[w] for w in p.split()])) for p, label in BASE_PHRASES.items()]
    return Index([t[0] for t in TEMPLATES], words, phrases, rare, hashes[order], base)


def _words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every word."""
    low = LOWER[buf]
    starts, ends = spans(LICENSE_WORD[low], offsets)
    return word_hashes(low, starts, ends), rows_of(starts, offsets)


def document_frequencies(docs: DataFrame) -> tuple[dict[str, int], int]:
    """In how many documents each licence word occurs, over all documents, and their number.

    What reaches the driver is one row per word of the fixed vocabulary.
    """
    names = vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(names)
        order = np.argsort(hashes)
        total, documents = np.zeros(len(names), np.int64), 0
        for batch in batches:
            for low, high, buf, offsets in text_slices(batch.column(0)):
                found, row = _words(buf, offsets)
                at = np.searchsorted(hashes[order], found)
                at[at == len(names)] = 0
                hit = hashes[order][at] == found
                pairs = np.unique(row[hit] * len(names) + order[at[hit]])
                total += np.bincount(pairs % len(names), minlength=len(names))
                documents += high - low
        yield pa.RecordBatch.from_arrays(
            [pa.array([*names, ""]), pa.array([*total.tolist(), documents], pa.int64())], ["word", "n"]
        )

    counts = whole_texts(docs).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n"))
    frequency = {row[0]: row[1] for row in counts.collect()}
    return frequency, frequency.pop("", 0)


def _phrase_places(numbers: np.ndarray, row: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Words at which the phrase starts, within one text."""
    n = len(numbers) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(numbers[:n] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[numbers[at + k] == phrase[k]]
    return at[row[at] == row[at + len(phrase) - 1]]


def _matches(index: Index, numbers: np.ndarray) -> dict[int, float]:
    """Templates found in one file and the share of each one's words at its best place."""
    found: dict[int, float] = {}
    for t, (words, rare) in enumerate(zip(index.words, index.rare)):
        posting = np.flatnonzero(np.isin(words, rare))
        places = np.flatnonzero(np.isin(numbers, rare))
        if not len(places):
            continue
        # Every occurrence of a rare word votes for the starts that its postings imply.
        i, j = np.nonzero(numbers[places][:, None] == words[posting][None, :])
        start, word = places[i] - posting[j], words[posting[j]]
        order = np.argsort(start, kind="stable")
        start, word = start[order], word[order]
        starts = np.unique(start)
        low = np.searchsorted(start, starts - SLACK)
        high = np.searchsorted(start, starts + SLACK, side="right")
        needed = min(2, len(set(rare.tolist())))
        # Votes near a start are no more than the template's rare words within the slack.
        for s, first, last in zip(starts.tolist(), low.tolist(), high.tolist()):
            if len(set(word[first:last].tolist())) < needed:
                continue
            if not all(_stands(numbers, s + place, phrase) for place, phrase in index.phrases[t]):
                continue
            share = _share(numbers, s, words)
            if share >= LEAST_SHARE:
                found[t] = max(found.get(t, 0.0), share)
    return found


def _stands(numbers: np.ndarray, at: int, phrase: np.ndarray) -> bool:
    """Whether the phrase stands within SLACK words of the place."""
    for s in range(max(0, at - SLACK), at + SLACK + 1):
        if np.array_equal(numbers[s : s + len(phrase)], phrase):
            return True
    return False


def _share(numbers: np.ndarray, start: int, words: np.ndarray) -> float:
    """The share of the template's words that stand within SLACK words of their place."""
    hits = 0
    for k, w in enumerate(words.tolist()):
        low = max(0, start + k - SLACK)
        hits += w in numbers[low : max(0, start + k + SLACK + 1)]
    return hits / len(words)


def scan(docs: DataFrame) -> DataFrame:
    """Licence labels of every whole text.

    Columns: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.
    ``score`` is the largest share of a matched template's words that stand in their places, 1 if
    only a base phrase is found, 0 without labels. A null or empty text has no words and empty
    labels. Rows are judged one by one, repeated ones too; an empty table gives no rows; further
    columns are ignored.
    """
    prepare(docs.sparkSession)
    frequency, documents = document_frequencies(docs)
    index = build_index(frequency, documents)
    rare_words = np.unique(np.concatenate(index.rare))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, buf, offsets in text_slices(batch.column(1)):
                n = high - low
                hashes, row = _words(buf, offsets)
                numbers = index.numbers(hashes)
                words = np.bincount(row, minlength=n)
                begin = np.cumsum(words) - words
                count = np.zeros(n, np.int64)
                first = np.full(n, np.iinfo(np.int64).max)
                last = np.full(n, -1)
                labels: list[set[str]] = [set() for _ in range(n)]
                for label, phrase in index.base:
                    at = _phrase_places(numbers, row, phrase)
                    np.add.at(count, row[at], 1)
                    np.minimum.at(first, row[at], at - begin[row[at]])
                    np.maximum.at(last, row[at], at - begin[row[at]])
                    for r in np.unique(row[at]).tolist():
                        labels[r].add(label)
                base = [",".join(sorted(x)) for x in labels]
                score = np.array([1.0 if x else 0.0 for x in labels])
                for r in np.unique(row[np.isin(numbers, rare_words)]).tolist():
                    matched = _matches(index, numbers[begin[r] : begin[r] + words[r]])
                    if matched:
                        labels[r] |= {index.labels[t] for t in matched}
                        score[r] = max(matched.values())
                none = count == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high],
                        pa.array(words.astype(np.int64)),
                        pa.array(count),
                        pa.array(first, mask=none),
                        pa.array(last.astype(np.int64), mask=none),
                        pa.array(base, pa.string()),
                        pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                        pa.array(score),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return whole_texts(docs, "doc_id").mapInArrow(
        judge,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
