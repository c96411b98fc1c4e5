"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.tables import table

from . import collocations, divergence, language, line_dedup, lsh_forest, packing, pii, quality, sentencepiece_bpe, simhash, suffix_dedup, topk, toxicity

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the vocabulary of byte_bpe_50k.json as ranks
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_documents(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, added=packing.added_tokens(VOCABULARY))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.topk(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"), pii.train())


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents"), PIECES)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.col("_lines.n").alias("n_lines"), F.col("_lines.removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256")
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_strings(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


REGISTRY = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_topk": op3_topk,
    "op4_quality": op4_quality,
    "op5_pii": op5_pii,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_language": op7_language,
    "op8_line_dedup": op8_line_dedup,
    "op9_minhash": op9_minhash,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_collocations": op12_collocations,
    "op13_divergence": op13_divergence,
}

ORACLE = {
    "op8_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, len(string_split(text, chr(10))) AS n, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS i
            FROM documents WHERE text <> ''
        ), solid AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos
            FROM lines WHERE regexp_matches(line, '[^ \\t\\r\\f\\v]')
        ), pairs AS (
            SELECT a.doc_id, a.pos, a.i, b.i AS j, 2 AS len, a.line AS x, b.line AS y
            FROM solid a JOIN solid b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
            UNION ALL
            SELECT doc_id, pos, i, i, 1, line, NULL FROM solid WHERE length(line) >= {line_dedup.LONG_LINE}
                OR (length(line) >= {line_dedup.SHORT_LINE} AND line IN
                    (SELECT line FROM solid GROUP BY line HAVING count(DISTINCT doc_id) >= {line_dedup.COMMON}))
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY len, x, y ORDER BY doc_id, pos) AS seen FROM pairs
        ), later AS (
            SELECT *, max(pos + len) OVER (PARTITION BY doc_id ORDER BY pos, len ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
            FROM ordered WHERE seen > 1
        ), runs AS (
            SELECT doc_id, min(i) AS i, max(j) AS j FROM (
                SELECT *, sum(CASE WHEN pos <= reach THEN 0 ELSE 1 END)
                    OVER (PARTITION BY doc_id ORDER BY pos, len ROWS UNBOUNDED PRECEDING) AS run FROM later
            ) GROUP BY doc_id, run
        ), gone AS (
            SELECT doc_id, unnest(range(i, j + 1)) AS i FROM runs
        ), kept AS (
            SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text, count(*) AS k
            FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
        )
        SELECT d.doc_id, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines,
               CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(string_split(text, chr(10))) - coalesce(k, 0) END AS n_removed,
               CASE WHEN text IS NULL THEN NULL ELSE sha256(coalesce(kept, '')) END AS kept_sha256
        FROM documents d LEFT JOIN (SELECT doc_id, text AS kept, k FROM kept) USING (doc_id)
    """,
    "op3_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op12_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[.,;:!?\n-\r]')) AS piece FROM documents
        ), words AS (
            SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
        ), totals AS (
            SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
        ), grams AS (
            SELECT lang, w, size, unnest(range(len(w) - size + 1)) AS i
            FROM words, range(1, 6) s(size) WHERE len(w) >= size
        ), f AS (
            SELECT lang, size, array_to_string(w[i + 1:i + size], ' ') AS phrase, count(*) AS f
            FROM grams GROUP BY ALL HAVING count(*) >= 100
        ), cuts AS (
            SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size > 1
        ), scored AS (
            SELECT c.*, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
            FROM cuts c JOIN totals USING (lang)
            JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:c.size], ' ')
        ), best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), kept AS (
            SELECT * FROM best b WHERE NOT EXISTS (
                SELECT 1 FROM best o
                WHERE o.lang = b.lang AND o.size > b.size AND o.a >= b.a AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' '))
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM kept QUALIFY rank <= 2000
    """,
    "op13_divergence": """
        WITH d AS (
            SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
            FROM documents
        ), occ AS (
            SELECT row_id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
        ), kept AS (
            SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30
        ), cells AS (
            SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
        ), groups AS (
            SELECT DISTINCT lang, source FROM d
        ), v AS (
            SELECT lang, count(*) AS v FROM kept GROUP BY lang
        ), grid AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
            FROM groups g JOIN kept k USING (lang) LEFT JOIN cells c USING (lang, source, term)
        ), own AS (
            SELECT lang, source, term, n,
                   1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p
            FROM grid JOIN v USING (lang)
        ), whole AS (
            SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
            FROM (SELECT lang, term, sum(n) AS n FROM grid GROUP BY lang, term) JOIN v USING (lang)
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN own x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN own y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY a.lang, a.source, b.source
        ), found AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL
            SELECT o.lang, o.source, 'term', o.term, o.p - w.q FROM own o JOIN whole w USING (lang, term) WHERE o.n > 0 AND o.p > w.q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
}
