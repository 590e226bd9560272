"""Registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import collocations, decontaminate, fill_middle, language_id, licenses, line_dedup, ngram_join, packing, quality, secrets, suffix_tree, vafile, warc


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages"))


def op3_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(_read(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_vafile_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(_read(spark, sf_dir, "embeddings"))


def op6_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_overlaps(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(_read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_read(spark, sf_dir, "documents"))


def op9_length_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.assign_batches(_read(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(_read(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(_read(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ngram_jaccard_join, op2_warc_chunks, op3_suffix_tree_scores, op4_quality_classifier, op5_vafile_top_k, op6_spaced_seed_decontamination, op7_secret_scan, op8_line_dedup, op9_length_bucket_packing, op10_license_scan, op11_phrase_collocations, op12_fill_in_middle, op13_language_id)}


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB where it can express the whole result."""
    return {
        "op1_ngram_jaccard_join": r"""
            WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
            s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM w),
            u AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM s),
            p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb FROM u a JOIN u b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
            l AS (SELECT a, b FROM p WHERE 100 * k >= 80 * (na + nb - k)),
            r(id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id)
            SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id FROM s JOIN (SELECT id, min(root) AS component_id FROM r GROUP BY id) c ON c.id = s.doc_id""",
        "op2_warc_chunks": """
            WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS h FROM pages),
            q AS (SELECT page_id, url, octet_length(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
            f AS (SELECT *, payload_bytes >= 100 AND row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, url NULLS LAST) > 1 AS again, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM q)
            SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to,
              greatest(1, ceil(CASE WHEN again THEN 0 ELSE payload_bytes END / 1048576.0))::BIGINT AS chunks, CASE WHEN again THEN NULL ELSE TRUE END AS verified
            FROM f""",
        "op5_vafile_top_k": """
            WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)) AS x FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
            s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
            FROM s QUALIFY rank <= 10""",
        "op11_phrase_collocations": r"""
            WITH s AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
            p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM s),
            w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
            g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase FROM w, (VALUES (1), (2), (3)) AS v(k) WHERE len(w) >= k),
            f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
            n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
            c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
            u AS (SELECT c.lang, c.k, phrase, a, j, array_to_string(w[1 : j], ' ') AS x, array_to_string(w[j + 1 :], ' ') AS y FROM c, (VALUES (1), (2)) AS v(j) WHERE j < c.k),
            q AS (SELECT u.*, x.f AS l, y.f AS r, (1000000::HUGEINT * u.a * u.a) // (x.f::HUGEINT * y.f) AS score FROM u JOIN f x ON x.lang = u.lang AND x.phrase = u.x JOIN f y ON y.lang = u.lang AND y.phrase = u.y),
            b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
            i AS (SELECT lang, phrase, max(a) AS m FROM (SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase FROM c WHERE k = 3) GROUP BY 1, 2),
            o AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE NOT coalesce(100 * i.m >= 50 * b.a, false)),
            t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
            SELECT t.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM t JOIN n ON n.lang = t.lang WHERE rank <= 2000""",
        "op12_fill_in_middle": """
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
            g AS (SELECT doc_id, t, length(t) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
            f AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
              CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
            p AS (SELECT *, t[1:a] AS pre, t[a + 1:b] AS mid, t[b + 1:] AS suf FROM f)
            SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
              sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
              sha256(t) AS restored_sha256 FROM p""",
    }
