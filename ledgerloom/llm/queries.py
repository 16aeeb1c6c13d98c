"""The registered queries of this subpackage and, where SQL can state the result, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import decontamination, html_text, language_id, merkle, near_vectors, quality, sentence_pieces, simhash, token_alignment, token_counts, toxicity, vector_search, warc
from .common import fold, table, vocabulary_path, with_small

TOKEN_LIMIT = 1024
TOXIC = 0.7
GOOD = 0.5


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = scratch_path(spark, "warc")
    warc.write(table(spark, folder, "pages"), "page_id", "url", "html", archive)
    return warc.summary(warc.read(spark, archive)).withColumnRenamed("key", "page_id")


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language_id.fit(docs.where(fold(F.col("doc_id"), 4) != 2), "text", "lang")
    return docs.select(
        "doc_id", held_out.alias("held_out"), language_id.predicted(docs, model, F.col("text")).alias("p")
    ).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    spaces = decontamination.build(docs, "text", table(spark, folder, "benchmark"), "item_id", "text")
    return docs.select("doc_id", F.explode(decontamination.leaks(docs, spaces, F.col("text"))).alias("l")).select("doc_id", "l.*")


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return sentence_pieces.digests(sentence_pieces.encode(docs, "doc_id", "text", vocabulary_path("piece_bpe_32k.model")))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.learn(docs, table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "text", "lang", "source", "n_chars")
    score = quality.scored(docs, model, *map(F.col, ("text", "lang", "source", "n_chars")))
    return docs.select("doc_id", score.alias("s")).select(
        "doc_id", "s.score", F.col("s.look").alias("text_score"), F.col("s.meta").alias("metadata_score"), (F.col("s.score") >= GOOD).alias("kept"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), "doc_id", "text")
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label")).where(fold(F.col("doc_id"), 3) != 1)
    model = toxicity.learn(with_small(docs.select("doc_id", "text"), labels, "doc_id"))
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return toxicity.score(docs, model, "text", "doc_id").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), "hits")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.count_tokens(
        table(spark, folder, "documents"), "doc_id", "text", vocabulary_path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_texts(table(spark, folder, "pages"), "page_id", "url", "html")


def op10_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.top_k(
        table(spark, folder, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0)


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.documents_manifest(table(spark, folder, "documents"))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align(
        table(spark, folder, "documents"), "doc_id", "text", vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))


def op13_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, folder, "embeddings"), "vec_id", "embedding", "label")


QUERIES = {
    "op1_warc": op1_warc,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_quality": op5_quality,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_html_text": op9_html_text,
    "op10_vector_search": op10_vector_search,
    "op11_merkle": op11_merkle,
    "op12_token_alignment": op12_token_alignment,
    "op13_near_vectors": op13_near_vectors,
}

ORACLE: dict[str, str] = {
    "op1_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS size,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS winner
            FROM pages)
        SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN size >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN size >= 1000 AND page_id <> winner THEN winner END AS refers_to
        FROM p""",
    "op10_vector_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.c) = len(v.c)
            WHERE q.vec_id % 100 = 0),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_merkle": """
        WITH RECURSIVE d AS (
            SELECT *, lang IS NULL AS no_lang, coalesce(lang, '') AS tree,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text,
                   xor(list_reduce(
                       [CAST(4294967295 AS UBIGINT)] || list_transform(
                           range(strlen(CAST(doc_id AS VARCHAR))),
                           lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER) + 1, 1)) AS UBIGINT)),
                       lambda c, b: list_reduce(
                           [xor(c, b)] || list_transform(range(8), lambda i: CAST(0 AS UBIGINT)),
                           lambda x, y: xor(x >> 1, (x & 1) * CAST(3988292384 AS UBIGINT)))),
                       CAST(4294967295 AS UBIGINT)) AS crc
            FROM documents),
        fields AS (
            SELECT *, concat(
                       coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'),
                       coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                       coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-')) AS head
            FROM d),
        hashed AS (
            SELECT doc_id, no_lang, tree,
                   sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(lower_text) || ':' || lower_text, '-')) END AS changed
            FROM fields),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY no_lang, tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                   count(*) OVER (PARTITION BY no_lang, tree) AS n
            FROM hashed),
        below(no_lang, tree, level, i, n, h) AS (
            SELECT no_lang, tree, 0, i, n, leaf FROM leaves
            UNION ALL
            SELECT no_lang, tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
            FROM below WHERE n > 1 GROUP BY no_lang, tree, level, i // 8, n),
        subroots AS (
            SELECT no_lang, tree, h AS subroot,
                   row_number() OVER (ORDER BY no_lang DESC, encode(tree)) - 1 AS i, count(*) OVER () AS n
            FROM below WHERE n = 1),
        above(level, i, n, h) AS (
            SELECT 0, i, n, subroot FROM subroots
            UNION ALL
            SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
            FROM above WHERE n > 1 GROUP BY level, i // 8, n),
        nodes AS (
            SELECT no_lang, tree, level, i, h FROM below WHERE n > 1),
        path AS (
            SELECT l.no_lang, l.tree, l.i, b.level,
                   string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < l.i // power) AS lft,
                   string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > l.i // power) AS rgt
            FROM (SELECT *, CAST(8 ** e AS BIGINT) AS power, e
                  FROM leaves, (SELECT unnest(range(12)) AS e)) AS l
            JOIN nodes AS b ON b.no_lang = l.no_lang AND b.tree = l.tree AND b.level = l.e AND b.i // 8 = l.i // (8 * l.power)
            GROUP BY l.no_lang, l.tree, l.i, b.level),
        top_path AS (
            SELECT l.no_lang, l.tree, b.level,
                   string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < l.i // power) AS lft,
                   string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > l.i // power) AS rgt
            FROM (SELECT *, CAST(8 ** e AS BIGINT) AS power, e
                  FROM subroots, (SELECT unnest(range(12)) AS e)) AS l
            JOIN above AS b ON b.n > 1 AND b.level = l.e AND b.i // 8 = l.i // (8 * l.power)
            GROUP BY l.no_lang, l.tree, b.level),
        steps AS (
            SELECT no_lang, tree, i, level, coalesce(lft, '') AS lft, coalesce(rgt, '') AS rgt FROM path
            UNION ALL
            SELECT l.no_lang, l.tree, l.i, 100 + p.level, coalesce(p.lft, ''), coalesce(p.rgt, '')
            FROM leaves AS l JOIN top_path AS p ON p.no_lang = l.no_lang AND p.tree = l.tree),
        proof AS (
            SELECT no_lang, tree, i, sha256(string_agg(lft || rgt, '' ORDER BY level)) AS proof_sha256,
                   list({'lft': lft, 'rgt': rgt} ORDER BY level) AS way
            FROM steps GROUP BY no_lang, tree, i),
        fold(no_lang, tree, i, h, way) AS (
            SELECT l.no_lang, l.tree, l.i, coalesce(l.changed, l.leaf), coalesce(p.way, [])
            FROM leaves AS l LEFT JOIN proof AS p ON p.no_lang = l.no_lang AND p.tree = l.tree AND p.i = l.i
            UNION ALL
            SELECT no_lang, tree, i, sha256(way[1].lft || h || way[1].rgt), way[2:] FROM fold WHERE len(way) > 0)
        SELECT l.doc_id, l.leaf, s.subroot, a.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
               f.h AS folded_root, f.h = a.h AS verified
        FROM leaves AS l
        JOIN subroots AS s ON s.no_lang = l.no_lang AND s.tree = l.tree
        JOIN above AS a ON a.n = 1
        LEFT JOIN proof AS p ON p.no_lang = l.no_lang AND p.tree = l.tree AND p.i = l.i
        JOIN fold AS f ON f.no_lang = l.no_lang AND f.tree = l.tree AND f.i = l.i AND len(f.way) = 0""",
    "op13_near_vectors": """
        WITH RECURSIVE v AS (
            SELECT DISTINCT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
                   coalesce(label IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
                            AND len(list_filter(embedding, lambda c: c <> 0)) > 0, false) AS known
            FROM embeddings),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.known AND b.known AND len(a.x) = len(b.x)
            WHERE list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.98),
        reach(a, b) AS (
            SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON l.a = r.b)
        SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, least(v.vec_id, coalesce(c.least, v.vec_id)) AS component_id,
               v.vec_id <= coalesce(c.least, v.vec_id) AS kept
        FROM v
        LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) AS n ON n.a = v.vec_id
        LEFT JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) AS c ON c.a = v.vec_id""",
}
