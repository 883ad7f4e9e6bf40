"""DuckDB twins of the fixture derivations in ``sources/fixtures.py``.

Every oracle query starts with :data:`PRELUDE` (common table expressions over
the driver's views) so both engines see the same input rows.
"""

from __future__ import annotations


def sql_pad5(x: str) -> str:
    return f"format('{{:05d}}', {x})"


def sql_parent(p: str) -> str:
    return f"regexp_extract({p}, '^(.*)/[^/]*$', 1)"


def sql_file(p: str) -> str:
    return f"regexp_extract({p}, '([^/]*)$', 1)"


def sql_stem(f: str) -> str:
    s = f"regexp_extract({f}, '^(\\.*[^.].*)\\.[^.]*$', 1)"
    return f"(CASE WHEN {s} = '' THEN {f} ELSE {s} END)"


def sql_page_path(p: str, n: str) -> str:
    parent, base = sql_parent(p), sql_stem(sql_file(p))
    folder = f"(CASE WHEN {parent} = '' THEN {base} ELSE {parent} || '/' || {base} END)"
    return f"({folder} || '/' || {base} || '-page-' || {sql_pad5(n)} || '.png')"


def sql_stage(m: int) -> str:
    r = f"((src_id * {m} + n) % 5)"
    return f"(CASE WHEN {r} = 0 THEN 'PENDING' WHEN {r} = 1 THEN 'FAILED' ELSE 'SUCCESS' END)"


TS = "TIMESTAMP '2024-01-01 00:00:00'"

_CTES = {
    "docs_bp": """docs_bp AS (
  SELECT *, source || '/' || lang || '/doc-' || CAST(doc_id AS VARCHAR) || '.pdf' AS bp
  FROM documents)""",
    "storage": """storage AS (
  SELECT CASE WHEN doc_id % 10 = 1 THEN 'moved/' || bp ELSE bp END AS path,
         text AS content, n_chars AS length
  FROM docs_bp WHERE doc_id % 10 <> 2)""",
    "scan": """scan AS (
  SELECT path, sha256(content) AS content_hash, sha256(content || path) AS doc_id, length
  FROM storage)""",
    "registry": f"""registry AS (
  SELECT sha256(text || bp) AS doc_id, bp AS path,
         CASE WHEN doc_id % 10 = 4 THEN '' ELSE sha256(text) END AS content_hash,
         CASE WHEN doc_id % 10 = 3 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
         {TS} AS created_at, {TS} AS updated_at
  FROM docs_bp WHERE doc_id % 10 <> 0)""",
    "snap": """snap AS (
  SELECT path, doc_id, content_hash FROM (
    SELECT path, doc_id, coalesce(content_hash, '') AS content_hash,
           row_number() OVER (PARTITION BY path ORDER BY created_at DESC, doc_id DESC) AS rn
    FROM registry WHERE status = 'ACTIVE') t WHERE rn = 1)""",
    "holders": """holders AS (
  SELECT content_hash, max(path) AS old_path FROM snap
  WHERE content_hash <> '' GROUP BY content_hash)""",
    "page_texts": """page_texts AS (
  SELECT d.doc_id AS src_id, sha256(d.text || d.bp) AS doc_id, CAST(g.n AS INTEGER) AS n,
         d.bp AS pdf_path, substr(d.text, CAST((g.n - 1) * 1000 + 1 AS INTEGER), 1000) AS text
  FROM docs_bp d,
       generate_series(1, greatest(1, CAST(ceil(d.n_chars / 1000.0) AS BIGINT))) AS g(n))""",
    "pages": f"""pages_f3 AS (
  SELECT doc_id || '_' || {sql_pad5('n')} AS page_id, doc_id, n AS page_number,
         {sql_page_path('pdf_path', 'n')} AS gcs_path, pdf_path AS gcs_pdf_path,
         CASE {sql_stage(1)} WHEN 'SUCCESS' THEN text WHEN 'FAILED' THEN '' END AS extracted_text,
         CASE {sql_stage(2)} WHEN 'SUCCESS' THEN text WHEN 'FAILED' THEN '' END AS summary,
         CAST(NULL AS FLOAT[]) AS embedding,
         {sql_stage(1)} AS extracted, {sql_stage(2)} AS summarized,
         {sql_stage(3)} AS embedded, {sql_stage(4)} AS indexed,
         CASE WHEN {sql_stage(1)} = 'FAILED' THEN 'extract error'
              WHEN {sql_stage(2)} = 'FAILED' THEN 'summary error'
              WHEN {sql_stage(3)} = 'FAILED' THEN 'embedding error'
              WHEN {sql_stage(4)} = 'FAILED' THEN 'indexing error' END AS error_message,
         CASE WHEN src_id % 10 = 3 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
         {TS} AS created_at, {TS} AS updated_at
  FROM page_texts)""",
    "page_vectors": f"""page_vectors AS (
  SELECT p.doc_id || '_' || {sql_pad5('p.n')} AS page_id, e.embedding
  FROM page_texts p JOIN embeddings e ON e.vec_id = p.src_id
  WHERE ((p.src_id * 3 + p.n) % 5) NOT IN (0, 1))""",
}

PRELUDE = "WITH " + ",\n".join(_CTES.values())


def q(select: str, *ctes: str) -> str:
    """An oracle statement: fixture prelude, the query's own CTEs, the select."""
    parts = [PRELUDE] + list(ctes)
    return ",\n".join(parts) + "\n" + select
