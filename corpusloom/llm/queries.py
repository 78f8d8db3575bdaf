"""The registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import _common, decontaminate, hard_negatives, html_extract, near_dedup, phrases, quality, secret_scan, seed_extend, sentencepiece, suffix_dedup, topk, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), keep="")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).drop("passages")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _common.scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_extend.dedup(table(spark, sf_dir, "documents"), keep=False)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).drop("found")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return hard_negatives.mine(rows, F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"]))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_suffix_array_dedup, op3_quality_classifier, op4_minhash_near_dedup, op5_toxicity, op6_benchmark_decontamination, op7_warc, op8_sentencepiece, op9_exact_topk, op10_substring_dedup, op11_secret_scan, op12_phrase_mining, op13_hard_negatives)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE = {
    "op9_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS i FROM s WHERE same) WHERE i <= 5
        ), n AS (
            SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
    """,
    "op2_suffix_array_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
        win AS (SELECT doc_id, unnest(range(0, n - 49)) AS p, h FROM d WHERE n >= 50),
        w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 100)) AS k FROM win),
        least AS (SELECT k, min(doc_id) AS first FROM w GROUP BY k),
        hit AS (SELECT doc_id, p FROM w JOIN least USING (k) WHERE first < doc_id),
        g AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS s FROM hit),
        r AS (SELECT doc_id, sum(s) OVER (PARTITION BY doc_id ORDER BY p) AS run, p FROM g),
        runs AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM r GROUP BY doc_id, run),
        piece AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM runs UNION ALL SELECT d.doc_id, coalesce(max(b), 0), n FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id, n),
        kept AS (SELECT doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS t FROM piece JOIN d USING (doc_id) GROUP BY doc_id),
        gone AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(t)) AS kept_sha256 FROM d JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
    """,
    "op10_substring_dedup": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM d WHERE len(w) >= 50),
        h AS (SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 49), ' ')) AS h FROM win),
        least AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
        hit AS (SELECT h.doc_id, h.p FROM h JOIN least USING (h) WHERE first < h.doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM hit),
        n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
        words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op12_phrase_mining": """
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS p FROM documents),
        s AS (SELECT lang, unnest(p) AS s FROM d),
        pieces AS (SELECT lang, regexp_extract_all(s, '[^\\x20\\x09]+') AS w FROM s),
        g AS (
            SELECT lang, 1 AS words, unnest(w) AS phrase FROM pieces
            UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(list_slice(w, i, i + 1), ' '))) FROM pieces WHERE len(w) > 1
            UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' '))) FROM pieces WHERE len(w) > 2
            UNION ALL SELECT lang, 4, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) FROM pieces WHERE len(w) > 3
        ),
        f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY lang, words, phrase),
        n AS (SELECT lang, sum(f) AS n FROM f WHERE words = 1 GROUP BY lang),
        c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 30),
        cut AS (SELECT lang, phrase, a, w, unnest(range(1, words)) AS k, words FROM c),
        cuts AS (SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS x, array_to_string(list_slice(w, k + 1, words), ' ') AS y FROM cut),
        scored AS (
            SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, CAST(2000000 * CAST(c.a AS HUGEINT) // (l.f + r.f) AS BIGINT) AS score
            FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.x JOIN f r ON r.lang = c.lang AND r.phrase = c.y
        ),
        weakest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM scored) WHERE i = 1),
        part AS (
            SELECT lang, a, unnest(list_concat([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')], CASE WHEN words = 4 THEN [array_to_string(list_slice(w, 3, 4), ' '), array_to_string(list_slice(w, 1, 3), ' '), array_to_string(list_slice(w, 2, 4), ' ')] ELSE [] END)) AS phrase
            FROM c WHERE words > 2
        ),
        longer AS (SELECT lang, phrase, max(a) AS longer FROM part GROUP BY lang, phrase),
        kept AS (SELECT w.* FROM weakest w LEFT JOIN longer o ON o.lang = w.lang AND o.phrase = w.phrase WHERE o.longer IS NULL OR 100 * o.longer < 80 * w.a),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS INTEGER) AS rank FROM kept)
        SELECT r.lang, r.rank, r.phrase, CAST(r.a AS BIGINT) AS a, CAST(r.l AS BIGINT) AS l, CAST(r.r AS BIGINT) AS r, CAST(n.n AS BIGINT) AS n, r.score FROM ranked r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
    """,
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        x AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS hex, max(page_id) OVER (PARTITION BY sha1(h)) AS first FROM p)
        SELECT page_id, payload_bytes,
            array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31 AS BIGINT), 1)), '') AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to,
            CASE WHEN page_id = first THEN TRUE END AS digest_ok
        FROM x
    """,
}
