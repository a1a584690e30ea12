"""One query for each operator, with its production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm import (
    collocations, dartminhash, exact_search, grid_join, licences, mixing, neighbours, ngram_trie, pieces, quality, segment_negatives, suffix_index, toxicity,
)

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Wanted shares of tokens by language.
TARGETS = {"en": 0.56, "de": 0.17, "fr": 0.16, "es": 0.11}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_languages(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """(doc_id, domain): the language of the rows that the table of labels covers."""
    covered = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(covered, "doc_id", "left_semi")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, labelled_languages(spark, sf_dir, docs), TARGETS)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_documents(table(spark, sf_dir, "documents"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.score_texts(table(spark, sf_dir, "documents"), order=3, least=1)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.remove_repeats(table(spark, sf_dir, "documents"))


def op11_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_search.sparse_rows(table(spark, sf_dir, "embeddings"), scale=64)
    return exact_search.search(rows, F.col("vec_id") % 20 == 0, k=20)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return segment_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_neighbours, op2_licences, op3_embedding_dedup, op4_mixing, op5_sentencepiece, op6_quality, op7_toxicity, op8_minhash_dedup, op9_lm_scores,
        op10_suffix_dedup, op11_exact_search, op12_collocations, op13_hard_negatives,
    )
}

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0"
_SCALED = "list_transform(embedding, lambda x: floor({scale} * x::DOUBLE))"

_OP11 = f"""
WITH v AS (SELECT vec_id, {_SCALED.format(scale=64)} AS e FROM embeddings WHERE vec_id IS NOT NULL AND {_FINITE}),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs) WHERE rank <= 20"""

_OP12 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS (SELECT lang, d, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pn FROM d),
w AS (SELECT lang, d, pn, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
u AS (SELECT lang, d, pn, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM u WINDOW o AS (PARTITION BY d, pn ORDER BY i)),
f AS MATERIALIZED (SELECT lang, 1 AS m, w1 AS phrase, count(*) AS f FROM g GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 10),
k AS (SELECT *, array_to_string(ws[1 : k], ' ') AS head, array_to_string(ws[k + 1 : m], ' ') AS rest FROM c, (VALUES (1), (2)) s(k) WHERE k < m),
s AS (SELECT k.*, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = head JOIN f r ON r.lang = k.lang AND r.phrase = rest),
lowest AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (SELECT lang, a, array_to_string(ws[1 : 2], ' ') AS part FROM c WHERE m = 3 UNION ALL SELECT lang, a, array_to_string(ws[2 : 3], ' ') FROM c WHERE m = 3),
inside AS (SELECT lang, part, max(a) AS longer FROM parts GROUP BY ALL),
kept AS (SELECT o.* FROM lowest o LEFT JOIN inside i ON i.lang = o.lang AND i.part = o.phrase WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank FROM kept) JOIN n USING (lang) WHERE rank <= 2000"""

_OP13 = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_SCALED.format(scale=256)} AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINITE}),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
      FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
      FROM pos JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
WHERE rank <= 3"""

ORACLE_SQL: dict[str, str] = {"op11_exact_search": _OP11, "op12_collocations": _OP12, "op13_hard_negatives": _OP13}
