"""One query for each operator over its whole table, with production parameters, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import byte_bpe
from tidemark.llm.conversation_repair import damaged, repair_reports
from tidemark.llm.embedding_near_dedup import near_vectors
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.hard_negatives import mine_hard_negatives
from tidemark.llm.language_id import MixtureModel, id_hash, language_id
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.ngram_jaccard import ngram_jaccard
from tidemark.llm.personal_data import KINDS, personal_data, spans_text
from tidemark.llm.quality_rules import learn, score_quality
from tidemark.llm.secret_scan import scan_digest, secret_scan
from tidemark.llm.source_mixing import mix_sources
from tidemark.llm.substring_dedup import substring_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and removed lines of every document, and a digest of the kept text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_hash("doc_id") % 5 == 0
    scored = score_quality(docs, learn(docs, labels.filter(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_hash("doc_id") % 4 == 2
    found = language_id(docs.select("doc_id", "text"), MixtureModel.fit(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=False)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_digest(secret_scan(table(spark, sf_dir, "documents")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label_col=moved)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_reports(damaged(table(spark, sf_dir, "conversations")), gone=F.col("gone"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_embedding_near_dedup, op2_line_dedup, op3_substring_dedup, op4_quality_rules, op5_exact_dedup, op6_language_id, op7_ngram_jaccard, op8_source_mixing, op9_byte_bpe, op10_secret_scan, op11_hard_negatives, op12_personal_data, op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embedding_near_dedup": r"""
            WITH RECURSIVE v AS (
                SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            ),
            fine AS (
                SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0
            ),
            links AS (
                SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98
            ),
            reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
            SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, min(r.b) AS component_id, vec_id = min(r.b) AS kept
            FROM embeddings JOIN reach r ON r.a = vec_id GROUP BY vec_id
        """,
        "op2_line_dedup": r"""
            WITH line AS (
                SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)
            ),
            placed AS (SELECT *, CAST(doc_id AS HUGEINT) * 4294967296 + i AS spot, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS ws FROM line),
            sets AS (SELECT ws, len(ws) AS n, min(spot) AS spot, row_number() OVER (ORDER BY min(spot)) AS c FROM placed WHERE len(ws) > 0 GROUP BY ws),
            token AS (SELECT c, n, unnest(ws) AS w FROM sets),
            rarity AS (SELECT w, row_number() OVER (ORDER BY count(*), w) AS r FROM token GROUP BY w),
            prefix AS (SELECT c, n, r FROM token JOIN rarity USING (w) QUALIFY row_number() OVER (PARTITION BY c ORDER BY r) <= n - ceil(0.75 * n) + 1),
            near AS (SELECT DISTINCT a.c AS a, b.c AS b FROM prefix a JOIN prefix b ON a.r = b.r AND a.c < b.c AND 100 * a.n >= 75 * b.n AND 100 * b.n >= 75 * a.n),
            earlier AS (
                SELECT b AS c, min(x.spot) AS first FROM near JOIN sets x ON x.c = a JOIN sets y ON y.c = b
                WHERE 100 * len(list_intersect(x.ws, y.ws)) >= 75 * (x.n + y.n - len(list_intersect(x.ws, y.ws))) GROUP BY b
            ),
            judged AS (
                SELECT p.doc_id, p.line, p.i, s.c IS NOT NULL AND p.spot > least(s.spot, coalesce(e.first, s.spot)) AS gone FROM placed p LEFT JOIN sets s ON p.ws = s.ws LEFT JOIN earlier e ON e.c = s.c
            ),
            kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text FROM judged GROUP BY doc_id)
            SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(kept.text) AS kept_sha256 FROM documents LEFT JOIN kept USING (doc_id)
        """,
        "op3_substring_dedup": r"""
            WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
            win AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w)),
            starts AS (SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k),
            hit AS (SELECT doc_id, i FROM win JOIN starts USING (k) WHERE first_doc < doc_id),
            gone AS (SELECT DISTINCT doc_id, i + j AS p FROM hit, (SELECT unnest(generate_series(0, 12)) AS j)),
            word AS (SELECT doc_id, unnest(ws) AS x, unnest(generate_series(1, len(ws))) AS p FROM w),
            kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
            SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
            FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)
        """,
        "op7_ngram_jaccard": r"""
            WITH RECURSIVE w AS (
                SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
            ),
            shingle AS (
                SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w)
                UNION SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4
            ),
            size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
            both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
            links AS (SELECT a, b FROM both_have x JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * x.n >= 75 * (p.n + q.n - x.n)),
            reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
            SELECT w.doc_id, coalesce(size.n, 0) AS n_shingles, min(reach.b) AS component_id
            FROM w LEFT JOIN size USING (doc_id) JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id, size.n
        """,
        "op8_source_mixing": r"""
            WITH base AS (
                SELECT doc_id, coalesce('=' || source, '') AS source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(concat_ws(':', doc_id, text)) AS place FROM documents
            ),
            src AS (
                SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source = '', source) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap
                FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, max(size) AS largest FROM base GROUP BY source)
            ),
            -- sources are held in order of cap / weight; the level is that of all not yet held
            levels AS (
                SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
                FROM src WINDOW before AS (ORDER BY cap / weight, source = '', source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            ),
            targets AS (
                SELECT *, CASE WHEN weight * level >= cap THEN cap ELSE weight * (SELECT arg_min(level, cap / weight) FROM levels WHERE weight * level < cap) END AS target FROM levels
            ),
            rates AS (
                SELECT source, source_size, target, largest / greatest(source_size, 1) / 8 AS reach, CASE WHEN target > 0 AND source_size > 0 THEN round(target / source_size, 9) ELSE 0.0::DOUBLE END AS rate FROM targets
            ),
            classes AS (
                SELECT *, round(rate - floor(rate), 9) AS f, CAST(coalesce(sum(n) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
                FROM (SELECT source, size, count(*) AS n FROM base GROUP BY ALL) JOIN rates USING (source)
            ),
            choices AS (SELECT (i + 0.5::DOUBLE) / 16 AS phase, j AS nudge FROM range(16) a(i), range(-8, 9) b(j)),
            fractions AS (
                SELECT source, phase, nudge, target, rate, CASE WHEN f = 0 THEN 0.0::DOUBLE ELSE round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, f + nudge * reach)), 9) END AS g
                FROM (SELECT DISTINCT source, target, rate, f, reach FROM classes), choices
            ),
            tried AS (
                SELECT source, phase, nudge, g, abs(sum(size * (n * floor(c.rate) + floor((before + n) * g + phase) - floor(before * g + phase))) - any_value(c.target)) AS off
                FROM classes c JOIN fractions USING (source) WHERE size > 0 GROUP BY source, phase, nudge, g
            ),
            best AS (SELECT * FROM tried QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, abs(nudge), phase, nudge) = 1),
            numbered AS (SELECT *, row_number() OVER (PARTITION BY source, size ORDER BY place) AS k FROM base)
            SELECT doc_id, size, source_size, target,
                CAST(size * CASE WHEN size = 0 THEN 0 ELSE least(2, floor(rate) + floor((before + k) * g + phase) - floor((before + k - 1) * g + phase)) END AS BIGINT) AS taken
            FROM numbered JOIN classes USING (source, size) LEFT JOIN best USING (source)
        """,
        "op11_hard_negatives": r"""
            WITH v AS (
                SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x) FOR x IN CAST(embedding AS DOUBLE[])] AS e FROM embeddings
                WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
            ),
            s AS (
                SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
                FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0
            ),
            p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
            SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
            FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score QUALIFY rank <= 3
        """,
        "op5_exact_dedup": r"""
            WITH n AS (
                SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
            )
            SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
                   doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
            FROM n WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)
        """,
    }
