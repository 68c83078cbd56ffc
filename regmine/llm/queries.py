"""Registered queries of the training-data operators (contract columns only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from regmine.llm import (bpe, decontamination, dedup, jaccard, langid, mining, packing, quality, secrets,
                         sharding, topk, training_order, whitening)
from regmine.llm.common import tokenizer_path


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe_codec(spark, sf_dir):
    """Encode and decode every text."""
    return bpe.encode_documents(_docs(spark, sf_dir), tokenizer_path())


def _remainder(column: str, n: int):
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def op2_language_id(spark, sf_dir):
    """Language of every text; learns from the other two thirds."""
    docs = _docs(spark, sf_dir)
    model = langid.train(docs, _remainder("doc_id", 3) != 1)
    out = langid.predict(docs, model)
    return out.select("doc_id", (_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op3_exact_topk(spark, sf_dir):
    """The five best candidates of every 50th vector."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.pmod(F.col("vec_id"), F.lit(50)) == 0, k=5)


def op4_jaccard_join(spark, sf_dir):
    """Components of documents with a shingle similarity of 0.8 or more."""
    return jaccard.near_copies(_docs(spark, sf_dir))


def op5_best_fit_packing(spark, sf_dir):
    """Pack all documents into sequences of 1024 ids."""
    return packing.pack_documents(_docs(spark, sf_dir), tokenizer_path(), capacity=1024, end_id=2)


def op6_exact_dedup(spark, sf_dir):
    """Owners of equal texts; the largest doc_id stays."""
    out = dedup.exact_duplicates(_docs(spark, sf_dir), keep="largest")
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_training_order(spark, sf_dir):
    """Shards of all documents' ids in a keyed random order."""
    return training_order.materialise(_docs(spark, sf_dir), tokenizer_path(), key=20240229)


def op8_byte_shards(spark, sf_dir):
    """All documents in 24 shards of near-equal bytes."""
    return sharding.shard_by_bytes(_docs(spark, sf_dir), 24)


def op9_quality_classifier(spark, sf_dir):
    """Quality score of every text; learns from three quarters of the labels."""
    docs = _docs(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, _remainder("doc_id", 4) != 2)
    out = quality.score(docs, model)
    return out.select("doc_id", (_remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op10_secret_scan(spark, sf_dir):
    """Secrets of every text, weak ones only with their complements."""
    return secrets.scan_secrets(_docs(spark, sf_dir))


def op11_whitening(spark, sf_dir):
    """Every vector on the four leading components, whitened."""
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=4)


def op12_hard_negatives(spark, sf_dir):
    """Ten hard negatives for the five positives of every 100th vector."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(vectors, label, F.col("vec_id") % 100 == 0)


def op13_decontamination(spark, sf_dir):
    """Words of every document inside ten-word windows of the benchmark."""
    index = decontamination.build_index(_docs(spark, sf_dir))
    found = decontamination.phrase_matches(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    return decontamination.contamination(index, found)


QUERIES = {f.__name__: f for f in (
    op1_bpe_codec, op2_language_id, op3_exact_topk, op4_jaccard_join,
    op5_best_fit_packing, op6_exact_dedup, op7_training_order, op8_byte_shards, op9_quality_classifier, op10_secret_scan,
    op11_whitening, op12_hard_negatives, op13_decontamination)}

ORACLE = {
    "op3_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                          list_inner_product(a.e, c.e)::BIGINT AS score
                   FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
             p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM (
            SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
            FROM p JOIN s USING (anchor_id)
            WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
        WHERE rank <= 10""",
    "op4_jaccard_join": r"""
        WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
                   FROM documents),
             g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
                     ELSE list_distinct(list_transform(range(1, len(w) - 3),
                          lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))) END AS s FROM t),
             u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM g),
             o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
                   FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n
                     AND 100 * b.n >= 80 * a.n GROUP BY 1, 2),
             l AS (SELECT a, b FROM o WHERE 100 * c >= 80 * (na + nb - c)),
             r(doc_id, reach) AS (SELECT doc_id, doc_id FROM g UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reach = l.a)
        SELECT g.doc_id, len(g.s) AS n_shingles, c.component_id FROM g
        JOIN (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY 1) c USING (doc_id)""",
    "op6_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id,
               count(*) OVER (PARTITION BY x) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256 FROM t""",
    "op13_decontamination": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                   FROM documents),
             b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                   FROM benchmark),
             k AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
             u AS (SELECT DISTINCT item_id, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS g
                   FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM k)),
             g AS (SELECT r, k, i, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS g
                   FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
                         FROM d, (SELECT DISTINCT k FROM u) WHERE len(w) >= k)),
             h AS (SELECT r, k, i, item_id FROM g JOIN u USING (k, g)),
             p AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, i + unnest(range(0, k)) AS p FROM h) GROUP BY r),
             n AS (SELECT r, count(DISTINCT item_id) AS n_items,
                          coalesce(string_agg(DISTINCT item_id, ',' ORDER BY item_id), '') AS ids FROM h GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN p USING (r) LEFT JOIN n USING (r)""",
}
