"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notequarry.llm import (
    collocations,
    exact_dedup,
    hard_negatives,
    html_main,
    language_id,
    lm_scoring,
    packing,
    pii,
    piece_encoding,
    quality,
    shard_shuffle,
    simhash,
    top_k,
)
from notequarry.llm.common import table

#: Public vocabulary files; the operators take the path of a file.
WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
VOCABULARIES = os.path.dirname(WORDS)
#: Key of the surrogates of these queries; a real run brings its own secret.
SURROGATE_KEY = "corpus surrogates, change for real data"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: DuckDB: a text with A-Z lower-cased, null as empty.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op1_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(lowered) AS text_sha256
FROM (SELECT doc_id, {LOWERED} AS lowered FROM documents)
WINDOW same AS (PARTITION BY lowered)
"""


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"))


@query
def op3_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


@query
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


ORACLES["op4_top_k"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


@query
def op7_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_main.extract(pages, html_main.fit(pages))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORDS)


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents"), SURROGATE_KEY).select("doc_id", "text", "n_replaced")


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding.encode_digests(table(spark, sf_dir, "documents"), PIECES)


@query
def op11_shard_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_shuffle.document_shards(table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors, F.col("id") % 100 == 0, label=moved)


ORACLES["op12_hard_negatives"] = """
WITH whole AS (
    SELECT row_number() OVER () AS nr, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.nr, a.vec_id AS anchor_id, c.nr AS other, c.vec_id, a.label = c.label AS same,
           CAST(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
    FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND a.nr <> c.nr
), near AS (
    SELECT *, row_number() OVER (PARTITION BY nr ORDER BY score DESC, vec_id) AS nth FROM scored WHERE same
), pairs AS (
    SELECT p.nr, p.anchor_id, p.nth, p.vec_id AS positive_id, p.score AS positive_score,
           n.vec_id AS negative_id, n.score AS negative_score
    FROM near p JOIN scored n ON p.nth <= 5 AND n.nr = p.nr AND NOT n.same
     AND 30 * CAST(p.score AS HUGEINT) <= 100 * CAST(n.score AS HUGEINT)
     AND 100 * CAST(n.score AS HUGEINT) <= 90 * CAST(p.score AS HUGEINT)
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY nr, nth ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank
    FROM pairs
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def _phrases(least: int, top: int) -> str:
    """DuckDB: collocations of ``documents`` from all stretches of one to four words."""
    words = "list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '')"
    return f"""
WITH pieces AS (
    SELECT lang, {words} AS w FROM (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\n\x0B\f\r]')) AS piece
        FROM documents)
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0
), stretches AS (
    SELECT lang, w[i : i + size - 1] AS p, size FROM starts, (SELECT unnest([1, 2, 3, 4]) AS size)
    WHERE i + size - 1 <= len(w)
), totals AS (
    SELECT lang, count(*) AS n FROM starts GROUP BY lang
), counts AS (
    SELECT lang, p, size, count(*) AS f FROM stretches GROUP BY lang, p, size HAVING count(*) >= {least}
), inside AS (
    SELECT c.lang, unnest([c.p[i : i + part - 1] for i in range(1, c.size - part + 2)]) AS p, c.f
    FROM counts c, (SELECT unnest([2, 3]) AS part) WHERE part < c.size
), around AS (
    SELECT lang, p, max(f) AS f FROM inside GROUP BY lang, p
), kept AS (
    SELECT c.* FROM counts c LEFT JOIN around o ON c.lang = o.lang AND c.p = o.p
    WHERE c.size > 1 AND (o.f IS NULL OR 100 * CAST(o.f AS HUGEINT) < 80 * CAST(c.f AS HUGEINT))
), cut AS (
    SELECT c.lang, c.p, c.f AS a, x.k, l.f AS l, r.f AS r,
           CAST((2000000 * CAST(c.f AS HUGEINT)) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
    FROM kept c JOIN (SELECT unnest([1, 2, 3]) AS k) x ON x.k < c.size
    JOIN counts l ON l.lang = c.lang AND l.p = c.p[1 : x.k]
    JOIN counts r ON r.lang = c.lang AND r.p = c.p[x.k + 1 : c.size]
), worst AS (
    SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS nth FROM cut
), named AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM worst WHERE nth = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}
"""


ORACLES["op13_collocations"] = _phrases(collocations.LEAST, collocations.TOP)
