"""Equal scores of different vectors, and capture times and URLs of any kind."""

from __future__ import annotations

import random
from datetime import UTC, datetime

import numpy as np

from rosterlens.llm import hilbert_neighbours, warc


def brute(found, k=5, every=50):
    out = []
    for q, v in found:
        if q % every:
            continue
        a = np.array(v, float)
        scored = []
        for i, w in found:
            if i != q:
                b = np.array(w, float)
                scored.append((-((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_equal_scores_of_scaled_vectors_go_to_the_smaller_ids(spark):
    rng = random.Random(4)
    base = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    found = [(i, [x * 2.0 ** (i % 30 - 15) for x in base[i % 3]]) for i in range(120)]
    found += [(200 + i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    rng.shuffle(found)
    table = spark.createDataFrame(found, "vec_id long, embedding array<double>").repartition(4)
    got = sorted(tuple(r) for r in hilbert_neighbours.neighbours(table).collect())
    expected = brute(found)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in got], [r[3] for r in expected], rtol=0, atol=1e-12)


def test_capture_times_do_not_depend_on_the_zone_of_the_session(spark):
    """Ids up to the largest, times around a change of the clock, and none lost in the year."""
    change = int(datetime(2024, 11, 3, 5, 30, tzinfo=UTC).timestamp()) - warc._EPOCH
    ids = [0, change, change + 3600, change + 7200, 3 * 10**11, 2**62, 2**63 - 1, -(2**63), -1]
    pages = spark.createDataFrame([(i, "http://a.org/", f"page {i}") for i in ids], "page_id long, url string, html string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        found = {r["page_id"]: r for r in warc.capture_index(pages).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert {i: r["captured"] for i, r in found.items()} == {i: i % warc._SPAN + warc._EPOCH for i in ids}
    order = sorted(found.values(), key=lambda r: (r["range_no"], r["place_in_range"]))
    assert [r["captured"] for r in order] == sorted(r["captured"] for r in order)


def test_urls_come_back_from_headers(spark):
    urls = ["http://a/%0A", "http://a/%250A", "http://a/%252525%0D", "http://a/x\ny\r\nz", "http://a/%0a%25", "%2", ""]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, html string")
    escaped = pages.select("page_id", warc._header_text(pages["url"]).alias("value")).collect()
    assert all("\n" not in r["value"] and "\r" not in r["value"] for r in escaped)
    assert [warc._header_value(r["value"]) for r in sorted(escaped)] == urls
    keys = {r["page_id"]: r["url_key"] for r in warc.capture_index(pages).collect()}
    assert keys == {i: warc.url_key(u) for i, u in enumerate(urls)}
