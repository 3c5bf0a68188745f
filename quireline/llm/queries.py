"""The queries of this subpackage: each one operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quireline.llm import decontamination, erasure, fingerprints, htmltext, infilling, linededup, neardup, packing, quality, rollups, secrets, tokenfiles, toxicity
from quireline.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents")))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "documents"), neardup.plan(3, 85))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_cascading_erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shop's clients, clicks, sales and lines stored as files, and the drawn masters' rows taken out of them."""
    return erasure.query(*(table(spark, sf_dir, t.name) for t in erasure.SHOP))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and turned around, as digests of the output and of the text restored from it."""
    return infilling.digest(infilling.infilled(table(spark, sf_dir, "documents")))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, written to files and read back from them."""
    return tokenfiles.query(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_token_counts": op5_token_counts,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_secret_scan": op9_secret_scan,
    "op10_toxicity": op10_toxicity,
    "op11_cascading_erasure": op11_cascading_erasure,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_token_files": op13_token_files,
}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES: dict[str, str] = {
    "op1_decontamination": f"""
        WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS own
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
        ),
        doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        size AS (SELECT DISTINCT n FROM win),
        place AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS own FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size)),
        hit AS (SELECT DISTINCT r, item_id, place.n, i FROM place JOIN win ON place.own = win.own AND place.n = win.n),
        word AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
        items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN word USING (r) LEFT JOIN items USING (r)
    """,
    "op2_line_dedup": r"""
        WITH line AS (SELECT doc_id, i - 1 AS line_no, l[i] AS line, string_split(trim(l[i], ' '), ' ') AS w, NOT regexp_matches(l[i], '[^\s\p{Z}\x0B\x1C-\x1F\x85]') AS blank FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
        own AS (SELECT w, min((doc_id, line_no)) AS pos FROM line WHERE NOT blank GROUP BY w),
        variant AS (
            SELECT pos, w, hash(array_to_string(w[1:i - 1], ' ') || chr(1) || array_to_string(w[i + 1:], ' ')) AS k FROM (SELECT pos, w, unnest(range(1, len(w) + 1)) AS i FROM own WHERE len(w) >= 10)
            UNION ALL
            SELECT pos, w, hash(array_to_string(w[1:i], ' ') || chr(1) || array_to_string(w[i + 1:], ' ')) AS k FROM (SELECT pos, w, unnest(range(0, len(w) + 1)) AS i FROM own WHERE len(w) >= 10)
        ),
        met AS (SELECT k, min(pos) AS pos FROM variant GROUP BY k HAVING count(*) > 1),
        near AS (SELECT DISTINCT variant.pos FROM variant JOIN met USING (k) WHERE variant.pos > met.pos),
        kept AS (SELECT pos FROM own WHERE pos NOT IN (SELECT pos FROM near)),
        said AS (SELECT doc_id, line_no, line, blank OR (doc_id, line_no) IN (SELECT pos FROM kept) AS stays FROM line),
        doc AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (stays), '') AS text FROM said GROUP BY doc_id)
        SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, doc.text FROM documents LEFT JOIN doc ON documents.doc_id = doc.doc_id
    """,
    "op12_fill_in_middle": """
        WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        num AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM doc),
        said AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM num
        ),
        cut AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM said)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256, sha256(text) AS restored_sha256
        FROM cut
    """,
}
