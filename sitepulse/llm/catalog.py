"""The corpus queries over the given tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitepulse.llm import alignment, audit, bpe, embedding, jaccard, license, mixing, pieces, quality, secrets, substring, toxicity, warc
from sitepulse.session import scratch_folder

#: Weights of the labelled domains in the mixed corpus.
TARGETS = {
    "quality1_toxic0": 0.85,
    "quality0_toxic0": 0.10,
    "quality1_toxic1": 0.04,
    "quality0_toxic1": 0.01,
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = scratch_folder(spark, "warc")
    warc.write_archive(_table(spark, folder, "pages"), archive)
    return warc.parse_records(warc.read_archive(spark, archive)).drop("uri")


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.clean_lines(_table(spark, folder, "documents"))


def op3_license(spark: SparkSession, folder: str) -> DataFrame:
    return license.scan_licenses(_table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return toxicity.score_documents(documents, toxicity.train(documents, _table(spark, folder, "labels")))


def op5_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join_documents(_table(spark, folder, "documents"), words=3, percent=90)


def op6_embedding(spark: SparkSession, folder: str) -> DataFrame:
    return embedding.link_vectors(_table(spark, folder, "embeddings"))


def op7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_documents(_table(spark, folder, "documents"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return secrets.scan_secrets(documents, secrets.train(documents))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return mixing.mix_documents(documents, labels, TARGETS).drop("text_hash")


def op10_substring(spark: SparkSession, folder: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, folder, "documents"))


def op11_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, folder, "documents"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(_table(spark, folder, "documents"))


def op13_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit_filters(spark, f"{folder}/documents.parquet", _table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_quality": op2_quality,
    "op3_license": op3_license,
    "op4_toxicity": op4_toxicity,
    "op5_jaccard": op5_jaccard,
    "op6_embedding": op6_embedding,
    "op7_pieces": op7_pieces,
    "op8_secrets": op8_secrets,
    "op9_mixing": op9_mixing,
    "op10_substring": op10_substring,
    "op11_bpe": op11_bpe,
    "op12_alignment": op12_alignment,
    "op13_audit": op13_audit,
}

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


SQL: dict[str, str] = {
    "op1_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body FROM pages
        ), g AS (
            SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
                   max(page_id) OVER (PARTITION BY body) AS holder
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = holder OR payload_bytes < 1000 THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = holder OR payload_bytes < 1000 THEN NULL ELSE holder END AS refers_to
        FROM g
    """,
    # The limits and phrases of the line rules.
    "op2_quality": rf"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents
        ), tri AS (
            SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
        ), rep AS (
            SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words
            FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM tri), (SELECT unnest([0, 1, 2]) AS o)
            WHERE n > 1 GROUP BY doc_id
        ), line AS (
            SELECT doc_id, pos, x, regexp_extract_all(x, {_WORD}) AS lw
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d)
        ), judged AS (
            SELECT doc_id, x, len(lw) AS n, list_sum(list_transform(lw, lambda y: length(y))) AS chars,
                   len(list_filter(lw, lambda y: y IN ('|', '||', '/', '>', '>>', '»', '›', '•', '·', '::'))) AS seps,
                   length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS symbols,
                   right(lw[-1], 1) AS last,
                   translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
                   row_number() OVER (PARTITION BY doc_id, x ORDER BY pos) AS nth
            FROM line WHERE len(lw) > 0
        ), failed AS (
            SELECT *, (seps >= 3 AND 100 * seps >= 15 * n)
                   OR 100 * symbols > 10 * chars
                   OR (n <= 30 AND regexp_matches(low, '{"|".join(quality.BOILERPLATE)}'))
                   OR (n < 8 AND last NOT IN ({_quoted(sorted(quality.TERMINAL))})) AS bad
            FROM judged
        ), s AS (
            SELECT doc_id, sum(CASE WHEN bad THEN chars ELSE 0 END) AS lost, count_if(bad) AS removed,
                   count_if(nth > 1) AS dup
            FROM failed GROUP BY doc_id
        ), f AS (
            SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda y: length(y))), 0) AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   coalesce(dup, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(removed, 0) AS removed_lines, coalesce(lost, 0) AS lost_chars
            FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN s USING (doc_id)
        )
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
               n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
               (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_chars <= 30 * word_chars AS kept,
               removed_lines::BIGINT AS removed_lines, lost_chars::BIGINT AS lost_chars
        FROM f
    """,
    "op5_jaccard": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents
        ), s AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS sh
            FROM w
        ), t AS (
            SELECT doc_id, len(sh) AS n, unnest(sh) AS k FROM s
        ), link AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM t a JOIN t b ON a.k = b.k AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
        ), low AS (
            SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
        )
        SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id FROM s JOIN low USING (doc_id)
    """,
    "op6_embedding": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
        ), ok AS (
            SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL
              AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0
        ), link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
            WHERE list_cosine_similarity(a.x, b.x) >= 0.93
        ), reach AS (
            SELECT vec_id, vec_id AS other FROM v
            UNION
            SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.other
        ), low AS (
            SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
        ), n AS (
            SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a
        )
        SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN low USING (vec_id) LEFT JOIN n USING (vec_id)
    """,
    "op10_substring": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents
        ), win AS (
            SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)
        ), low AS (
            SELECT k, min(doc_id) AS first FROM win GROUP BY k HAVING count(*) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, i + o AS p
            FROM win JOIN low USING (k), (SELECT unnest(range(0, 50)) AS o) WHERE first < doc_id
        ), word AS (
            SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d
        ), kept AS (
            SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS body
            FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(body, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op13_audit": rf"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), {_WORD}) AS w,
                   min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
            FROM documents
        ), l AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                   max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels GROUP BY doc_id
        ), f AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
                   (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
                   || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
                   || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END)
                   || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
                   || (CASE WHEN first_id < d.doc_id THEN 'E' ELSE '' END) AS fails
            FROM d LEFT JOIN l USING (doc_id)
        ), c AS (
            SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL
        ), letter AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
        ), orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letter a, letter b, letter c, letter d, letter e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), steps AS (
            SELECT filter_order, step, filter_order[step] AS x, filter_order[1:step - 1] AS earlier
            FROM orders, (SELECT unnest(range(1, 6)) AS step)
        ), judged AS (
            SELECT part, filter_order, step, x, n, good, c.toxic, fails,
                   contains(fails, x) AS failing, translate(fails, earlier, '') <> fails AS gone
            FROM c, steps
        ), report AS (
            SELECT part, filter_order, step, x,
                   coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS kept,
                   coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS removed,
                   coalesce(sum(n) FILTER (gone AND failing), 0) AS redundant,
                   coalesce(sum(n) FILTER (fails = x), 0) AS unique_fails,
                   coalesce(sum(n) FILTER (NOT gone AND failing AND good = 1), 0) AS good_lost,
                   coalesce(sum(n) FILTER (NOT gone AND failing AND toxic = 1), 0) AS toxic_lost
            FROM judged GROUP BY part, filter_order, step, x
        )
        SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
               redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
               toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
        FROM report
    """,
}
