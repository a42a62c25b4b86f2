"""The queries of this package on the driver tables, and their equivalents in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rosterlens.llm import bpe, exact_dedup, fill_in_middle, hilbert_neighbours, jaccard_join, language_gru, licenses, packing, phrase_mining, pii_crf, simhash_anchors, substring_dedup, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"))


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_index(_table(spark, sf_dir, "pages"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_language_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_gru.predict(_table(spark, sf_dir, "documents"))


def op1_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.spans_of(_table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(_table(spark, sf_dir, "documents"))


def op6_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_neighbours.neighbours(_table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(_table(spark, sf_dir, "documents"))


def op13_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_anchors.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op6_hilbert_neighbours": op6_hilbert_neighbours,
    "op5_substring_dedup": op5_substring_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op1_pii_crf": op1_pii_crf,
    "op8_language_gru": op8_language_gru,
    "op10_license_scan": op10_license_scan,
    "op3_warc_index": op3_warc_index,
    "op2_exact_dedup": op2_exact_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_simhash_anchors": op13_simhash_anchors,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLE_SQL: dict[str, str] = {
    "op5_substring_dedup": f"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)
), repeated AS (
    SELECT doc_id, i FROM windows
    WHERE s IN (SELECT s FROM windows GROUP BY s HAVING count(*) > 1)
), removed AS (
    SELECT doc_id, list(DISTINCT p) AS gone
    FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM repeated) GROUP BY doc_id
), split AS (
    SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
           list_filter(w, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)) AS kept
    FROM words LEFT JOIN removed USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM split
""",
    "op7_jaccard_join": f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(w) = 0 THEN []
             WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY ALL
), links AS (
    SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * c >= 75 * (a.n + b.n - c)
), reach(x, y) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT x AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id
FROM reach LEFT JOIN sizes ON sizes.doc_id = x
GROUP BY x
""",
    "op2_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op12_fill_in_middle": r"""
WITH tokens AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest
    FROM documents
), drawn AS (
    SELECT doc_id, text, t, len(t) AS n,
           ('0x' || digest[1:8])::BIGINT AS h1, ('0x' || digest[9:16])::BIGINT AS h2,
           ('0x' || digest[17:24])::BIGINT AS h3, ('0x' || digest[25:32])::BIGINT AS h4
    FROM tokens
), cut AS (
    SELECT doc_id, text, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT doc_id, text, n, form, coalesce(array_to_string(t[1:a], ''), '') AS p,
           coalesce(array_to_string(t[a + 1:b], ''), '') AS m, coalesce(array_to_string(t[b + 1:], ''), '') AS s
    FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
    "op11_phrase_mining": rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, k AS size, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) AS sizes(k))
), f AS (
    SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), candidates AS (
    SELECT lang, size, phrase, n AS a FROM f WHERE size > 1 AND n >= 10
), cuts AS (
    SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:], ' ') AS rest
    FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
    SELECT c.lang, c.phrase, c.a, k, x.n AS l, y.n AS r,
           (1000000::HUGEINT * c.a * c.a) // (x.n::HUGEINT * y.n) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = first_part JOIN f y ON y.lang = c.lang AND y.phrase = rest
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
    FROM (SELECT lang, a, string_split(phrase, ' ') AS w FROM candidates WHERE size = 3)
), kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a >= 50 * b.a)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, totals.n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
}
