"""DuckDB oracle SQL, one statement per registered query key.

Written independently of the Spark code (plain SQL over the same fixture
derivations); column names equal the Spark aliases.
"""

from __future__ import annotations

from ..functions.paths import DESCRIPTIONS  # fixed values shared as data
from ..functions.text import ENTITIES, HIDDEN
from .oracle_fixtures import q, sql_file, sql_page_path, sql_pad5, sql_parent, sql_stem

ORACLE: dict[str, str] = {}

_NEW_PATHS = "fresh AS (SELECT s.* FROM scan s WHERE NOT EXISTS (SELECT 1 FROM snap r WHERE r.path = s.path))"

ORACLE["scan_manifest"] = q("SELECT path, content_hash, doc_id, length FROM all_scan", """all_scan AS (
  SELECT bp AS path, sha256(text) AS content_hash, sha256(text || bp) AS doc_id, n_chars AS length FROM docs_bp)""")

ORACLE["registry_snapshot"] = q("SELECT path, doc_id, content_hash FROM snap")

ORACLE["new_documents"] = q("""
SELECT path, doc_id, content_hash FROM scan s
WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.doc_id = s.doc_id)""")

ORACLE["changes_new"] = q("""
SELECT path, doc_id, content_hash FROM fresh f
WHERE NOT EXISTS (SELECT 1 FROM holders h WHERE h.content_hash = f.content_hash)""", _NEW_PATHS)

ORACLE["changes_moved"] = q("""
SELECT h.old_path, f.path AS new_path, f.content_hash, f.doc_id
FROM fresh f JOIN holders h ON h.content_hash = f.content_hash""", _NEW_PATHS)

ORACLE["changes_deleted"] = q("""
SELECT r.path, r.doc_id, r.content_hash FROM snap r
WHERE r.content_hash <> ''
  AND NOT EXISTS (SELECT 1 FROM scan s WHERE s.path = r.path)
  AND NOT EXISTS (SELECT 1 FROM scan s WHERE s.content_hash = r.content_hash)""")

ORACLE["changes_unchanged"] = q("""
SELECT s.path, s.doc_id, s.content_hash FROM scan s
WHERE EXISTS (SELECT 1 FROM snap r WHERE r.path = s.path)""")

_DETECT = """detected AS (
  SELECT 'unchanged' AS change, s.path, CAST(NULL AS VARCHAR) AS old_path, s.doc_id, s.content_hash
  FROM scan s JOIN snap r ON r.path = s.path
  UNION ALL
  SELECT 'new', f.path, NULL, f.doc_id, f.content_hash FROM fresh f
  WHERE f.content_hash NOT IN (SELECT content_hash FROM holders)
  UNION ALL
  SELECT 'moved', f.path, h.old_path, f.doc_id, f.content_hash
  FROM fresh f JOIN holders h ON h.content_hash = f.content_hash
  UNION ALL
  SELECT 'deleted', r.path, NULL, r.doc_id, r.content_hash FROM snap r
  WHERE r.content_hash <> ''
    AND r.path NOT IN (SELECT path FROM scan)
    AND r.content_hash NOT IN (SELECT content_hash FROM scan))"""

ORACLE["detect_changes"] = q("SELECT change, path, old_path, doc_id, content_hash FROM detected",
                             _NEW_PATHS, _DETECT)

ORACLE["change_counts"] = q("SELECT change, count(*) AS n FROM detected GROUP BY change",
                            _NEW_PATHS, _DETECT)

ORACLE["duplicate_hashes"] = q("""
SELECT s.content_hash, s.path, c.copies
FROM (SELECT sha256(text) AS content_hash, bp AS path FROM docs_bp) s
JOIN (SELECT sha256(text) AS content_hash, count(*) AS copies FROM docs_bp
      GROUP BY sha256(text) HAVING count(*) > 1) c
  ON c.content_hash = s.content_hash""")

ORACLE["new_hash_counts"] = q("""
SELECT count(*) AS n_new, count(DISTINCT content_hash) AS n_distinct_hashes
FROM detected WHERE change = 'new'""", _NEW_PATHS, _DETECT)


# ---- helpers for the statements below ----------------------------------------


RUN = "TIMESTAMP '2024-06-01 00:00:00'"
NL = "chr(10)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def tokens(x: str) -> str:
    return f"list_filter(string_split_regex(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def blank(x: str) -> str:
    return f"(({x}) IS NULL OR NOT regexp_matches({x}, '[^\\t\\n\\x{{0b}}\\f\\r\\x{{85}}\\pZ\\x{{1c}}-\\x{{1f}}]'))"


def describe(p: str) -> str:
    cases = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in DESCRIPTIONS.items())
    return (f"array_to_string(list_transform(string_split({p}, '/'), "
            f"lambda k: CASE k {cases} ELSE '' END), {NL})")


def rr(x: str, pattern: str, repl: str = "''") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {repl}, 'g')"


def rep(x: str, a: str, b: str) -> str:
    return f"replace({x}, {a}, {b})"


def strip_hidden(t):
    t = rr(t, r"(?is)<head(\s[^>]*)?>.*?</head\s*>")
    for name in HIDDEN:
        t = rr(t, rf"(?is)<{name}(\s[^>]*)?>.*?</{name}\s*>")
    return rr(t, r"(?s)<!--.*?-->")


def tables(t):
    t = rr(t, r"(?is)<table(\s[^>]*)?>", f"{NL} || chr(1) || 'table' || chr(2) || {NL}")
    t = rr(t, r"(?is)</table\s*>", f"{NL} || chr(1) || '/table' || chr(2) || {NL}")
    t = rr(t, r"(?is)<caption(\s[^>]*)?>(.*?)</caption\s*>", f"'\\2' || {NL}")
    t = rr(t, r"(?is)<tr(\s[^>]*)?>", f"{NL} || '|'")
    t = rr(t, r"(?is)</t[hd]\s*>", "' |'")
    t = rr(t, r"(?is)<t[hd](\s[^>]*)?>", "' '")
    return rr(t, r"(?is)</tr\s*>")


def images(t):
    def blk(inner):
        return f"{NL} || chr(1) || 'image' || chr(2) || {inner} || chr(1) || '/image' || chr(2) || {NL}"
    t = rr(t, r"(?is)<figcaption(\s[^>]*)?>(.*?)</figcaption\s*>", blk("'\\2'"))
    t = rr(t, r'(?is)<img\s[^>]*alt="([^"]*)"[^>]*>', blk("'\\1'"))
    t = rr(t, r"(?is)<img\s[^>]*alt='([^']*)'[^>]*>", blk("'\\1'"))
    return rr(t, r"(?is)<img(\s[^>]*)?>", blk("''"))


def filler(t):
    return rr(t, r"(?:&amp;|[._#*$%&]){3,}")


def markdown(t):
    t = rr(t, r"(?i)<li(\s[^>]*)?>", f"{NL} || '- '")
    for n in range(1, 7):
        t = rr(t, rf"(?i)<h{n}(\s[^>]*)?>", f"{NL} || '{'#' * n} '")
    return rr(t, r"(?i)</?(p|h[1-6]|div|ul|ol|article|section|br)(\s[^>]*)?/?>", NL)


def tags(t):
    t = rr(t, r"(?s)<[^>]+>")
    for a, b in ENTITIES:
        t = rep(t, lit(a), lit(b))
    return rep(rep(t, "chr(1)", "'<'"), "chr(2)", "'>'")


def collapse(t):
    t = rr(t, r"[ \t\r\f]+", "' '")
    t = rr(t, r" ?\n ?", NL)
    t = rr(t, r"\n{3,}", f"{NL} || {NL}")
    return rr(t, r"^\s+|\s+$")


def finalize(t):
    return f"coalesce({rr(t, r'(?m)^```[^\n]*\n?')}, '')"


def chain(t):
    return finalize(collapse(tags(markdown(filler(images(tables(strip_hidden(t))))))))


QUEUE = {
    "extract": "status = 'ACTIVE' AND extracted IN ('PENDING', 'FAILED')",
    "summary": "status = 'ACTIVE' AND summarized IN ('PENDING', 'FAILED')",
    "embed": ("status = 'ACTIVE' AND extracted = 'SUCCESS' AND summarized = 'SUCCESS' "
              "AND embedded IN ('PENDING', 'FAILED')"),
    "index": "status = 'ACTIVE' AND embedded = 'SUCCESS' AND indexed IN ('PENDING', 'FAILED')",
}
STAGE_OF = {"extract": "extracted", "summary": "summarized", "embed": "embedded", "index": "indexed"}

_LISTING = "listing AS (SELECT bp AS path FROM docs_bp UNION ALL SELECT bp || '.txt' FROM docs_bp)"
# every document as a file, none deleted
_ALL = """all_scan AS (SELECT bp AS path, sha256(text) AS content_hash, sha256(text || bp) AS doc_id, n_chars AS length
  FROM docs_bp)"""
_FOLDERS = "[" + ", ".join(lit(k) for k in DESCRIPTIONS) + "]"
_DESCRIBED = f"""described AS (SELECT {_FOLDERS}[doc_id % {len(DESCRIPTIONS)} + 1] || '/'
  || {_FOLDERS}[(doc_id * 7 + 3) % {len(DESCRIPTIONS)} + 1] || '/' || bp AS path FROM docs_bp)"""
_MARKED = """marked AS (SELECT page_id, html || chr(10) || '<table class="t"><caption>page ' || page_id
  || '</caption><tr><th>url</th><th>n</th></tr><tr><td>' || url || '</td><td>' || page_id || '</td></tr></table>' || chr(10)
  || '<figure><img src=' || chr(39) || 'a.png' || chr(39) || ' alt=' || chr(39) || 'photo ' || page_id || chr(39) || '><figcaption>from ' || url
  || '</figcaption></figure><img alt="plan ' || page_id || '" src=b.png><img src=c.png>' || chr(10) || '```html' || chr(10)
  || 'code ' || page_id || chr(10) || '```' || chr(10) || 'end' AS html FROM pages)"""
_PAY = f"pay AS (SELECT doc_id || '_' || {sql_pad5('n')} AS page_id, doc_id, n AS page_number, pdf_path AS gcs_pdf_path, text FROM page_texts)"


def _set_status(src: str, ids: str) -> str:
    hit = f"(doc_id IN (SELECT doc_id FROM {ids}) AND status <> 'INACTIVE')"
    return (f"SELECT doc_id, path, content_hash, CASE WHEN {hit} THEN 'INACTIVE' ELSE status END AS status, "
            f"created_at, CASE WHEN {hit} THEN {RUN} ELSE updated_at END AS updated_at FROM {src}")


def _register(src: str, cand: str) -> str:
    return (f"SELECT * FROM {src} UNION ALL SELECT DISTINCT doc_id, path, content_hash, 'ACTIVE', {RUN}, {RUN} "
            f"FROM {cand} c WHERE c.doc_id NOT IN (SELECT doc_id FROM {src})")


# compat sync of the registry: deleted, moved, new (over `detected`)
_SYNC = [
    "del_ids AS (SELECT doc_id FROM detected WHERE change = 'deleted')",
    f"reg1 AS ({_set_status('registry', 'del_ids')})",
    "mv AS (SELECT old_path, path AS new_path, content_hash, doc_id FROM detected WHERE change = 'moved')",
    """src_ids AS (SELECT r.doc_id FROM reg1 r WHERE r.status = 'ACTIVE' AND EXISTS
      (SELECT 1 FROM mv WHERE mv.old_path = r.path AND mv.content_hash = r.content_hash))""",
    f"reg2 AS ({_set_status('reg1', 'src_ids')})",
    "mv_cand AS (SELECT doc_id, new_path AS path, content_hash FROM mv)",
    f"reg3 AS ({_register('reg2', 'mv_cand')})",
    "new_cand AS (SELECT doc_id, path, content_hash FROM detected WHERE change = 'new')",
    f"synced AS ({_register('reg3', 'new_cand')})",
]
_SYNCED = [_NEW_PATHS, _DETECT] + _SYNC

# ---- sources and scalar functions --------------------------------------------

ORACLE["list_files"] = q("SELECT path FROM listing WHERE lower(path) LIKE '%.pdf'", _LISTING)

ORACLE["content_hash"] = q("SELECT doc_id, sha256(text) AS content_hash FROM documents")

ORACLE["doc_hash"] = q("SELECT bp AS path, sha256(text || bp) AS doc_hash FROM docs_bp")

ORACLE["file_hash_algo"] = q("""
SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256,
       sha256(text || coalesce(source, '')) AS sha256_with_source FROM documents""")

ORACLE["split_path"] = q(f"""
SELECT path, {sql_parent('path')} AS parent, {sql_file('path')} AS file,
       {sql_stem(sql_file('path'))} AS stem FROM listing""", _LISTING)

ORACLE["page_paths"] = q(f"SELECT page_id, {sql_page_path('gcs_pdf_path', 'page_number')} AS gcs_path FROM pages_f3")

ORACLE["page_ids"] = q(f"SELECT doc_id || '_' || {sql_pad5('n')} AS page_id, {sql_pad5('n')} AS page_number FROM page_texts")

ORACLE["path_description"] = q(f"SELECT path, {describe('path')} AS description FROM described", _DESCRIBED)

ORACLE["path_description_table"] = q(f"""
SELECT p.path, string_agg(coalesce(d.description, ''), {NL} ORDER BY p.pos) AS description
FROM parts p LEFT JOIN descs d ON d.path_key = p.k GROUP BY p.path""",
    """parts AS (SELECT s.path, g.pos, string_split(s.path, '/')[g.pos] AS k
      FROM (SELECT DISTINCT bp AS path FROM docs_bp) s, generate_series(1, len(string_split(s.path, '/'))) AS g(pos))""",
    """descs AS (SELECT path_key, max(description) AS description FROM (
      SELECT source AS path_key, 'Documents from ' || source AS description FROM documents
      UNION SELECT lang, 'Written in ' || lang FROM documents) x GROUP BY path_key)""")

_COMBINED = f"coalesce(summary, '') || {NL} || {NL} || coalesce(extracted_text, '')"
ORACLE["combined_text"] = q(f"SELECT page_id, {_COMBINED} AS combined_text, {blank(_COMBINED)} AS blank FROM pages_f3")

ORACLE["embedding_json"] = q("""
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims, embedding FROM embeddings""")

# ---- lookups -----------------------------------------------------------------

ORACLE["all_doc_ids"] = q("SELECT DISTINCT doc_id FROM registry")

_PRESENT = """present AS (
  SELECT CASE WHEN doc_id % 10 = 1 THEN 'moved/' || bp ELSE bp END AS path, text AS content FROM docs_bp)"""

ORACLE["exists_document"] = q("""
SELECT s.doc_id, s.path, EXISTS (SELECT 1 FROM registry r WHERE r.doc_id = s.doc_id) AS "exists"
FROM (SELECT sha256(content || path) AS doc_id, path FROM present) s""", _PRESENT)

ORACLE["docs_by_content_hash"] = q("""
SELECT content_hash, doc_id, path FROM registry
WHERE status = 'ACTIVE' AND content_hash IN (SELECT sha256(content) FROM present)""", _PRESENT)

ORACLE["doc_id_by_content_hash"] = q("""
SELECT content_hash, min(doc_id) AS doc_id FROM registry
WHERE status = 'ACTIVE' AND content_hash <> '' GROUP BY content_hash""")

ORACLE["active_doc_ids"] = q("SELECT doc_id FROM registry WHERE status = 'ACTIVE'")

ORACLE["document_pages"] = q("""
SELECT p.page_id, p.doc_id, p.page_number, r.path AS doc_path, r.status AS doc_status
FROM pages_f3 p JOIN registry r ON r.doc_id = p.doc_id""")

ORACLE["queue_breakdown"] = q(" UNION ALL ".join(
    f"SELECT '{k}' AS queue, {STAGE_OF[k]} AS stage_status, count(*) AS n FROM pages_f3 "
    f"WHERE {c} GROUP BY {STAGE_OF[k]}" for k, c in QUEUE.items()))

for _k, _c in QUEUE.items():
    ORACLE[f"queue_{_k}"] = q(f"SELECT page_id, doc_id, page_number, gcs_path, {STAGE_OF[_k]} FROM pages_f3 WHERE {_c}")

ORACLE["queue_split"] = q("""
SELECT doc_id, path, content_hash FROM synced
WHERE status = 'ACTIVE' AND doc_id NOT IN (SELECT doc_id FROM pages_f3)""", *_SYNCED)

# ---- aggregates, top-k -------------------------------------------------------

_NOT_DONE = " OR ".join(f"{s} <> 'SUCCESS'" for s in STAGE_OF.values())
_DONE = " AND ".join(f"{s} = 'SUCCESS'" for s in STAGE_OF.values())

ORACLE["processing_complete"] = q(f"""
SELECT pending_pages, pending_pages = 0 AS complete FROM (
  SELECT count(*) FILTER (WHERE coalesce({_NOT_DONE}, false)) AS pending_pages
  FROM pages_f3 WHERE status = 'ACTIVE') t""")

ORACLE["processing_stats"] = q(f"""
SELECT total_active_pages, completed_pages, total_active_pages - completed_pages AS remaining_pages,
       CASE WHEN total_active_pages > 0 THEN completed_pages / total_active_pages * 100 ELSE 0.0 END
       AS completion_rate
FROM (SELECT count(*) AS total_active_pages,
             count(*) FILTER (WHERE coalesce({_DONE}, false)) AS completed_pages
      FROM pages_f3 WHERE status = 'ACTIVE') t""")

ORACLE["stage_progress"] = q(" UNION ALL ".join(
    f"SELECT '{s}' AS stage, {s} AS stage_status, count(*) AS n FROM pages_f3 WHERE status = 'ACTIVE' GROUP BY {s}"
    for s in STAGE_OF.values()))

ORACLE["first_n_pages"] = q("""
SELECT page_id, doc_id, page_number, gcs_path FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_number, page_id) AS rn FROM pages_f3) t
WHERE rn <= 5""")

# ---- pages -------------------------------------------------------------------

_SPLIT_ALL = f"""split_all AS (
  SELECT s.doc_id || '_' || {sql_pad5('g.n')} AS page_id, s.doc_id, CAST(g.n AS INTEGER) AS page_number,
         {sql_page_path('s.path', 'g.n')} AS gcs_path, s.path AS gcs_pdf_path,
         substr(s.content, CAST((g.n - 1) * 1000 + 1 AS INTEGER), 1000) AS text
  FROM docs_in s, generate_series(1, greatest(1, CAST(ceil(length(s.content) / 1000.0) AS BIGINT))) AS g(n))"""

ORACLE["paginate"] = q("SELECT page_id, doc_id, page_number, gcs_path, gcs_pdf_path, text FROM split_all",
                       "docs_in AS (SELECT sha256(text || bp) AS doc_id, bp AS path, text AS content FROM docs_bp)",
                       _SPLIT_ALL)

# ---- mutations ---------------------------------------------------------------

ORACLE["register_documents"] = q(
    "SELECT doc_id, path, content_hash, status, created_at, updated_at FROM reg_new",
    _NEW_PATHS, _DETECT, "new_cand AS (SELECT doc_id, path, content_hash FROM detected WHERE change = 'new')",
    f"reg_new AS ({_register('registry', 'new_cand')})")

ORACLE["apply_deleted"] = q(
    "SELECT * FROM reg_del",
    """del_ids AS (SELECT r.doc_id FROM snap r WHERE r.content_hash <> ''
      AND NOT EXISTS (SELECT 1 FROM scan s WHERE s.path = r.path)
      AND NOT EXISTS (SELECT 1 FROM scan s WHERE s.content_hash = r.content_hash))""",
    f"reg_del AS ({_set_status('registry', 'del_ids')})")

ORACLE["apply_moved"] = q(
    "SELECT * FROM reg_mv",
    _NEW_PATHS,
    "mv AS (SELECT h.old_path, f.path AS new_path, f.content_hash, f.doc_id FROM fresh f JOIN holders h ON h.content_hash = f.content_hash)",
    """src_ids AS (SELECT r.doc_id FROM registry r WHERE r.status = 'ACTIVE' AND EXISTS
      (SELECT 1 FROM mv WHERE mv.old_path = r.path AND mv.content_hash = r.content_hash))""",
    f"reg_off AS ({_set_status('registry', 'src_ids')})",
    "mv_cand AS (SELECT doc_id, new_path AS path, content_hash FROM mv)",
    f"reg_mv AS ({_register('reg_off', 'mv_cand')})")

ORACLE["apply_changes"] = q("SELECT * FROM synced", *_SYNCED)

ORACLE["register_pages"] = q(f"""
SELECT * FROM pages_f3 UNION ALL
SELECT page_id, doc_id, page_number, gcs_path, gcs_pdf_path, NULL, NULL, CAST(NULL AS FLOAT[]),
       'PENDING', 'PENDING', 'PENDING', 'PENDING', NULL, 'ACTIVE', {RUN}, {RUN}
FROM split_all WHERE page_id NOT IN (SELECT page_id FROM pages_f3)""",
    _PRESENT, "docs_in AS (SELECT sha256(content || path) AS doc_id, path, content FROM present)", _SPLIT_ALL)

ORACLE["patch_pages"] = q("""
SELECT p.page_id, coalesce(f.extracted_text, p.extracted_text) AS extracted_text,
       coalesce(f.extracted, p.extracted) AS extracted,
       coalesce(f.error_message, p.error_message) AS error_message,
       coalesce(f.updated_at, p.updated_at) AS updated_at
FROM pages_f3 p LEFT JOIN folded f ON f.page_id = p.page_id""",
    f"q_ext AS (SELECT page_id FROM pages_f3 WHERE {QUEUE['extract']})",
    _PAY,
    "de_docs AS (SELECT sha256(text || bp) AS doc_id FROM docs_bp WHERE lang = 'de')",
    f"""patches AS (
      SELECT q.page_id, 1 AS seq, p.text AS extracted_text, 'SUCCESS' AS extracted,
             CAST(NULL AS VARCHAR) AS error_message, {RUN} AS updated_at
      FROM q_ext q JOIN pay p ON p.page_id = q.page_id
      UNION ALL
      SELECT q.page_id, 2, '', 'FAILED', 'retry failed', {RUN}
      FROM q_ext q JOIN pay p ON p.page_id = q.page_id WHERE p.doc_id IN (SELECT doc_id FROM de_docs))""",
    """folded AS (SELECT page_id,
      arg_max(extracted_text, seq) FILTER (WHERE extracted_text IS NOT NULL) AS extracted_text,
      arg_max(extracted, seq) FILTER (WHERE extracted IS NOT NULL) AS extracted,
      arg_max(error_message, seq) FILTER (WHERE error_message IS NOT NULL) AS error_message,
      arg_max(updated_at, seq) FILTER (WHERE updated_at IS NOT NULL) AS updated_at
      FROM patches GROUP BY page_id)""")

ORACLE["compact_pages"] = ORACLE["patch_pages"]

# the whole state counted after the patches
_PATCHED = [ORACLE["patch_pages"][len(q("")):].split("\nSELECT p.page_id, coalesce(f.extracted_text")[0].lstrip(", \n"),
            """patched AS (SELECT p.* REPLACE (coalesce(f.extracted, p.extracted) AS extracted)
  FROM pages_f3 p LEFT JOIN folded f ON f.page_id = p.page_id)"""]
ORACLE["status_counts"] = q("""
SELECT status, extracted, summarized, embedded, indexed, CAST(count(*) AS BIGINT) AS n FROM patched GROUP BY ALL""", *_PATCHED)

ORACLE["stage_progress_kept"] = q(" UNION ALL ".join(
    f"SELECT '{s}' AS stage, {s} AS stage_status, CAST(count(*) AS BIGINT) AS n FROM patched WHERE status = 'ACTIVE' GROUP BY {s}"
    for s in STAGE_OF.values()), *_PATCHED)

_FLIPPED = """flipped AS (
  SELECT p.*, r.status AS d_status,
         coalesce(r.status IN ('ACTIVE', 'INACTIVE') AND p.status IN ('ACTIVE', 'INACTIVE')
                  AND r.status <> p.status, false) AS flip
  FROM pages_f3 p LEFT JOIN synced r ON r.doc_id = p.doc_id)"""

ORACLE["sync_page_status"] = q(f"""
SELECT page_id, doc_id, CASE WHEN flip THEN d_status ELSE status END AS status,
       CASE WHEN flip THEN {RUN} ELSE updated_at END AS updated_at FROM flipped""", *_SYNCED, _FLIPPED)

ORACLE["sync_page_status_counts"] = q("""
SELECT count(*) FILTER (WHERE flip AND d_status = 'INACTIVE') AS to_inactive,
       count(*) FILTER (WHERE flip AND d_status = 'ACTIVE') AS to_active FROM flipped""", *_SYNCED, _FLIPPED)

ORACLE["cascade_delete"] = q("SELECT page_id, doc_id FROM pages_f3 WHERE doc_id IN (SELECT doc_id FROM registry)")

# ---- text rules and page jobs ------------------------------------------------

ORACLE["text_strip_filler"] = q(f"SELECT page_id, {filler('html')} AS text FROM pages")
ORACLE["text_collapse_ws"] = q(f"SELECT page_id, {collapse('html')} AS text FROM pages")
ORACLE["text_markdown"] = q(f"SELECT page_id, {markdown('html')} AS text FROM pages")
ORACLE["text_tables"] = q(f"SELECT page_id, {tables('html')} AS text FROM marked", _MARKED)
ORACLE["text_images"] = q(f"SELECT page_id, {images('html')} AS text FROM marked", _MARKED)
ORACLE["text_finalize"] = q(f"SELECT page_id, {finalize('html')} AS text FROM marked", _MARKED)
ORACLE["extract_text"] = q(f"""
SELECT CAST(page_id AS VARCHAR) AS page_id, {chain('html')} AS value,
       CAST(NULL AS VARCHAR) AS error, 'SUCCESS' AS status FROM pages""")

ORACLE["situate_pages"] = q(f"""
SELECT page_id,
       CASE WHEN summary IS NULL THEN ''
            ELSE summary END AS value,
       CAST(NULL AS VARCHAR) AS error, 'SUCCESS' AS status
FROM (SELECT t.page_id, b.gcs_pdf_path || {NL} || {describe('b.gcs_pdf_path')} || {NL} || b.sentence AS summary
      FROM targets t LEFT JOIN best b ON b.page_id = t.page_id) x""",
    _PAY,
    f"targets AS (SELECT DISTINCT page_id FROM pages_f3 WHERE {QUEUE['summary']})",
    """ctx AS (SELECT doc_id, page_id, text FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_number, page_id) AS rn FROM pay) t
      WHERE rn <= 5)""",
    f"""ctx_tok AS (SELECT doc_id, tok, count(*) AS w FROM (
      SELECT doc_id, page_id, unnest(list_distinct({tokens('text')})) AS tok FROM ctx) t GROUP BY doc_id, tok)""",
    """tp AS (SELECT p.page_id, p.doc_id, p.gcs_pdf_path,
             string_split_regex(coalesce(p.text, ''), '[.!?]+\\s+|\\n+') AS arr
      FROM targets t JOIN pay p ON p.page_id = t.page_id)""",
    """sents AS (SELECT tp.page_id, tp.doc_id, tp.gcs_pdf_path, g.pos, tp.arr[g.pos] AS sentence
      FROM tp, generate_series(1, len(tp.arr)) AS g(pos)
      WHERE regexp_matches(tp.arr[g.pos], '[\\p{L}\\p{N}]'))""",
    f"""scored AS (SELECT st.page_id, st.pos, sum(coalesce(c.w, 0)) AS score FROM (
      SELECT page_id, doc_id, pos, unnest(list_distinct({tokens('sentence')})) AS tok FROM sents) st
      LEFT JOIN ctx_tok c ON c.doc_id = st.doc_id AND c.tok = st.tok GROUP BY st.page_id, st.pos)""",
    """best AS (SELECT page_id, gcs_pdf_path, sentence FROM (
      SELECT s.page_id, s.gcs_pdf_path, s.sentence,
             row_number() OVER (PARTITION BY s.page_id ORDER BY sc.score DESC, s.pos ASC) AS rn
      FROM sents s JOIN scored sc ON sc.page_id = s.page_id AND sc.pos = s.pos) t WHERE rn = 1)""")

ORACLE["embed_buckets"] = q("""
SELECT page_id, CAST(CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % 768 AS INTEGER) AS bucket,
       CAST(count(*) AS INTEGER) AS n
FROM toks GROUP BY ALL""",
    f"eq AS (SELECT page_id, {_COMBINED} AS txt FROM pages_f3 WHERE {QUEUE['embed']})",
    f"toks AS (SELECT page_id, unnest({tokens('txt')}) AS tok FROM eq WHERE NOT {blank('txt')})")

ORACLE["index_documents"] = q(f"""
SELECT q.page_id, q.doc_id, {sql_pad5('q.page_number')} AS page_number, q.status, q.gcs_path,
       q.gcs_pdf_path, q.extracted_text, q.summary, v.embedding, 'hashed-bow-768' AS model
FROM pages_f3 q JOIN page_vectors v ON v.page_id = q.page_id WHERE {QUEUE['index'].replace('status', 'q.status', 1)}""")

# ---- mirror ------------------------------------------------------------------

_MIRROR = """plan AS (
  SELECT coalesce(s.path, t.path) AS path,
         CASE WHEN t.path IS NULL THEN 'COPY' WHEN s.path IS NULL THEN 'DELETE'
              WHEN s.content_hash IS DISTINCT FROM t.content_hash THEN 'UPDATE' ELSE 'SKIP' END AS action
  FROM scan s FULL OUTER JOIN snap t ON s.path = t.path)"""
ORACLE["mirror_plan"] = q("SELECT path, action FROM plan", _MIRROR)
ORACLE["mirror_plan_counts"] = q("SELECT action, count(*) AS n FROM plan GROUP BY action", _MIRROR)

# ---- D10 strict classes --------------------------------------------------------

_STRICT = [
    """s_cls AS (
  SELECT s.path, s.doc_id, s.content_hash, r.doc_id AS r_doc,
    CASE WHEN r.doc_id IS NOT NULL AND (r.content_hash = s.content_hash OR r.content_hash = '') THEN 'UNCHANGED'
         WHEN r.doc_id IS NOT NULL THEN 'MODIFIED'
         WHEN s.doc_id IN (SELECT doc_id FROM registry WHERE status = 'INACTIVE') THEN 'RESURRECTED'
         WHEN s.content_hash IN (SELECT content_hash FROM snap WHERE content_hash <> '') THEN '_CAND'
         ELSE 'NEW' END AS change
  FROM scan s LEFT JOIN snap r ON r.path = s.path)""",
    """cand AS (SELECT content_hash, path, doc_id,
         row_number() OVER (PARTITION BY content_hash ORDER BY path) AS rn
  FROM s_cls WHERE change = '_CAND')""",
    """vac AS (SELECT content_hash, path AS old_path, doc_id AS old_doc_id,
         row_number() OVER (PARTITION BY content_hash ORDER BY path) AS rn
  FROM snap h WHERE content_hash <> ''
    AND NOT EXISTS (SELECT 1 FROM scan s WHERE s.path = h.path AND s.content_hash = h.content_hash))""",
    """strict AS (
  SELECT change, path, CAST(NULL AS VARCHAR) AS old_path, doc_id,
         CASE WHEN change IN ('UNCHANGED', 'MODIFIED') THEN r_doc END AS old_doc_id, content_hash
  FROM s_cls WHERE change <> '_CAND'
  UNION ALL
  SELECT CASE WHEN v.old_path IS NOT NULL THEN 'MOVED' ELSE 'COPIED' END, c.path, v.old_path, c.doc_id,
         v.old_doc_id, c.content_hash
  FROM cand c LEFT JOIN vac v ON v.content_hash = c.content_hash AND v.rn = c.rn
  UNION ALL
  SELECT CASE WHEN g.content_hash <> '' AND g.content_hash IN (SELECT content_hash FROM scan)
              THEN 'ORPHANED' ELSE 'DELETED' END,
         g.path, NULL, NULL, g.doc_id, g.content_hash
  FROM snap g WHERE g.path NOT IN (SELECT path FROM scan)
    AND NOT EXISTS (SELECT 1 FROM vac v JOIN cand c ON c.content_hash = v.content_hash AND c.rn = v.rn
                    WHERE v.old_path = g.path))""",
]

ORACLE["detect_changes_strict"] = q(
    "SELECT change, path, old_path, doc_id, old_doc_id, content_hash FROM strict", *_STRICT)

ORACLE["change_counts_strict"] = q("SELECT change, count(*) AS n FROM strict GROUP BY change", *_STRICT)

ORACLE["apply_changes_strict"] = q(
    "SELECT doc_id, path, content_hash, status, created_at, updated_at FROM strict_reg",
    *_STRICT,
    """acts AS (SELECT doc_id, arg_max(to_s, prio) FILTER (WHERE to_s IS NOT NULL) AS to_s, max(fill) AS fill
  FROM (SELECT old_doc_id AS doc_id, 'INACTIVE' AS to_s, CAST(NULL AS VARCHAR) AS fill, 1 AS prio FROM strict
        WHERE change IN ('MODIFIED', 'MOVED', 'ORPHANED', 'DELETED')
        UNION ALL SELECT doc_id, 'ACTIVE', NULL, 2 FROM strict WHERE change IN ('RESURRECTED', 'MODIFIED')
        UNION ALL SELECT old_doc_id, NULL, content_hash, 0 FROM strict WHERE change = 'UNCHANGED') x
  GROUP BY doc_id)""",
    f"""upd AS (SELECT doc_id, path, new_hash AS content_hash, new_status AS status, created_at,
         CASE WHEN new_status <> status OR coalesce(new_hash, '') <> coalesce(content_hash, '')
              THEN {RUN} ELSE updated_at END AS updated_at
  FROM (SELECT r.*, coalesce(a.to_s, r.status) AS new_status,
               CASE WHEN coalesce(r.content_hash, '') = '' AND a.fill IS NOT NULL THEN a.fill
                    ELSE r.content_hash END AS new_hash
        FROM registry r LEFT JOIN acts a ON a.doc_id = r.doc_id) y)""",
    """reg_cand AS (SELECT doc_id, path, content_hash FROM strict
  WHERE change IN ('MODIFIED', 'MOVED', 'COPIED', 'NEW'))""",
    f"strict_reg AS ({_register('upd', 'reg_cand')})")

# ---- whole runs ------------------------------------------------------------------

ORACLE["sync_run"] = q(f"""
SELECT count(*) AS total_active_pages,
       count(*) FILTER (WHERE coalesce({_DONE}, false)) AS completed_pages,
       count(*) - count(*) FILTER (WHERE coalesce({_DONE}, false)) AS remaining_pages,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE coalesce({_DONE}, false)) / count(*) * 100
            ELSE 0.0 END AS completion_rate
FROM (SELECT p.* REPLACE (CASE WHEN coalesce(r.status IN ('ACTIVE', 'INACTIVE') AND p.status IN ('ACTIVE', 'INACTIVE')
                                             AND r.status <> p.status, false)
                               THEN r.status ELSE p.status END AS status)
      FROM pages_f3 p LEFT JOIN strict_reg r ON r.doc_id = p.doc_id) t
WHERE status = 'ACTIVE'""",
    *_STRICT,
    ORACLE["apply_changes_strict"].split("strict AS (", 1)[0] and "acts AS (" + ORACLE["apply_changes_strict"].split("acts AS (", 1)[1].split("\nSELECT doc_id, path, content_hash, status, created_at, updated_at FROM strict_reg")[0])

ORACLE["incremental_ingest"] = q(f"""
SELECT sha256(text || bp) AS doc_id, bp AS path, sha256(text) AS content_hash, 'ACTIVE' AS status,
       {RUN} AS created_at, {RUN} AS updated_at FROM docs_bp""")

# each poll compared with the one before: by path, then deleted and new files of one content by order of path
ORACLE["watch_events"] = q("""
SELECT path, 'MODIFIED' AS event, content_hash, doc_id, old_content_hash, old_doc_id, seen_ms, CAST(NULL AS VARCHAR) AS old_path
FROM steps WHERE content_hash <> old_content_hash
UNION ALL
SELECT coalesce(c.path, g.path), CASE WHEN g.path IS NULL THEN 'NEW' WHEN c.path IS NULL THEN 'DELETED' ELSE 'MOVED' END,
       c.content_hash, c.doc_id, g.old_content_hash, g.old_doc_id, coalesce(c.seen_ms, g.seen_ms),
       CASE WHEN c.path IS NOT NULL THEN g.path END
FROM (SELECT *, row_number() OVER (PARTITION BY seen_ms, content_hash ORDER BY path) AS n FROM steps WHERE old_doc_id IS NULL) c
FULL JOIN (SELECT *, row_number() OVER (PARTITION BY seen_ms, old_content_hash ORDER BY path) AS n FROM steps WHERE doc_id IS NULL) g
  ON g.seen_ms = c.seen_ms AND g.old_content_hash = c.content_hash AND g.n = c.n""",
    """listed AS (
  SELECT t AS poll, path, sha256(content) AS content_hash, sha256(content || path) AS doc_id FROM (
    SELECT t, CASE WHEN t > 1 AND doc_id % 10 = 1 THEN 'moved/' || bp ELSE bp END AS path,
           CASE WHEN t > 1 AND doc_id % 10 = 3 THEN text || ' edited' ELSE text END AS content
    FROM docs_bp, range(1, 4) r(t) WHERE doc_id % 10 <> (CASE t WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 6 END)) f)""",
    """steps AS (
  SELECT coalesce(b.path, a.path) AS path, b.content_hash, b.doc_id, a.content_hash AS old_content_hash,
         a.doc_id AS old_doc_id, CAST(1000 * coalesce(b.poll, a.poll + 1) AS BIGINT) AS seen_ms
  FROM (SELECT * FROM listed WHERE poll < 3) a FULL JOIN listed b ON b.path = a.path AND b.poll = a.poll + 1)""")

# ---- embedding vectors (exact: integer counts, IEEE double division, float cast) ----------

ORACLE["embed_pages"] = q("""
SELECT page_id, value, CAST(NULL AS VARCHAR) AS error, 'SUCCESS' AS status FROM vec
UNION ALL
SELECT page_id, CAST(NULL AS FLOAT[]), 'text to embed is empty', 'FAILED' FROM eq WHERE is_blank""",
    f"eq AS (SELECT page_id, {_COMBINED} AS txt, {blank(_COMBINED)} AS is_blank FROM pages_f3 WHERE {QUEUE['embed']})",
    f"toks AS (SELECT page_id, unnest({tokens('txt')}) AS tok FROM eq WHERE NOT is_blank)",
    """cnt AS (SELECT page_id, CAST(CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % 768 AS INTEGER) AS b,
       count(*) AS n FROM toks GROUP BY ALL)""",
    "nrm AS (SELECT page_id, sqrt(CAST(sum(n * n) AS DOUBLE)) AS nrm FROM cnt GROUP BY page_id)",
    """vec AS (SELECT e.page_id,
       list(CAST(CASE WHEN nr.nrm > 0 THEN CAST(coalesce(c.n, 0) AS DOUBLE) / nr.nrm ELSE 0.0 END AS FLOAT)
            ORDER BY r.i) AS value
  FROM eq e CROSS JOIN range(768) r(i)
  LEFT JOIN cnt c ON c.page_id = e.page_id AND c.b = r.i
  LEFT JOIN nrm nr ON nr.page_id = e.page_id
  WHERE NOT e.is_blank GROUP BY e.page_id)""")

# ---- whole pipeline run (P7): the stages above composed over the run's state ----------


def _situate_ctes(p: str, targets: str, pay: str) -> list[str]:
    """Situate of SURVEY 2.9.2 as CTEs named with prefix ``p``; output ``{p}_res``."""
    return [
        f"""{p}_known AS (SELECT t.page_id, y.doc_id, y.gcs_pdf_path, y.text
  FROM (SELECT DISTINCT page_id FROM {targets}) t LEFT JOIN {pay} y ON y.page_id = t.page_id)""",
        f"""{p}_ctx AS (SELECT doc_id, page_id, text FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_number, page_id) AS rn FROM {pay}
  WHERE doc_id IN (SELECT doc_id FROM {p}_known WHERE doc_id IS NOT NULL)) t WHERE rn <= 5)""",
        f"""{p}_w AS (SELECT doc_id, tok, count(*) AS w FROM (
  SELECT doc_id, page_id, unnest(list_distinct({tokens('text')})) AS tok FROM {p}_ctx) t GROUP BY doc_id, tok)""",
        f"""{p}_tp AS (SELECT page_id, doc_id, gcs_pdf_path,
  string_split_regex(coalesce(text, ''), '[.!?]+\\s+|\\n+') AS arr FROM {p}_known WHERE doc_id IS NOT NULL)""",
        f"""{p}_s AS (SELECT tp.page_id, tp.doc_id, tp.gcs_pdf_path, g.pos, tp.arr[g.pos] AS sentence
  FROM {p}_tp tp, generate_series(1, len(tp.arr)) AS g(pos) WHERE regexp_matches(tp.arr[g.pos], '[\\p{{L}}\\p{{N}}]'))""",
        f"""{p}_sc AS (SELECT st.page_id, st.pos, sum(coalesce(c.w, 0)) AS score FROM (
  SELECT page_id, doc_id, pos, unnest(list_distinct({tokens('sentence')})) AS tok FROM {p}_s) st
  LEFT JOIN {p}_w c ON c.doc_id = st.doc_id AND c.tok = st.tok GROUP BY st.page_id, st.pos)""",
        f"""{p}_best AS (SELECT page_id, gcs_pdf_path || {NL} || {describe('gcs_pdf_path')} || {NL} || sentence AS summary FROM (
  SELECT s.page_id, s.gcs_pdf_path, s.sentence,
         row_number() OVER (PARTITION BY s.page_id ORDER BY sc.score DESC, s.pos ASC) AS rn
  FROM {p}_s s JOIN {p}_sc sc ON sc.page_id = s.page_id AND sc.pos = s.pos) t WHERE rn = 1)""",
        f"""{p}_res AS (
  SELECT k.page_id,
         CASE WHEN b.summary IS NULL THEN ''
              ELSE b.summary END AS value,
         CAST(NULL AS VARCHAR) AS error, 'SUCCESS' AS status
  FROM {p}_known k LEFT JOIN {p}_best b ON b.page_id = k.page_id WHERE k.doc_id IS NOT NULL
  UNION ALL
  SELECT page_id, NULL, 'no page row for ' || page_id, 'FAILED' FROM {p}_known WHERE doc_id IS NULL)""",
    ]


def _embed_ctes(p: str, queue: str) -> list[str]:
    comb = f"coalesce(summary, '') || {NL} || {NL} || coalesce(extracted_text, '')"
    return [
        f"{p}_eq AS (SELECT page_id, {comb} AS txt, {blank(comb)} AS is_blank FROM {queue})",
        f"{p}_tk AS (SELECT page_id, unnest({tokens('txt')}) AS tok FROM {p}_eq WHERE NOT is_blank)",
        f"""{p}_cnt AS (SELECT page_id, CAST(CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % 768 AS INTEGER) AS b,
  count(*) AS n FROM {p}_tk GROUP BY ALL)""",
        f"{p}_nrm AS (SELECT page_id, sqrt(CAST(sum(n * n) AS DOUBLE)) AS nrm FROM {p}_cnt GROUP BY page_id)",
        f"""{p}_res AS (
  SELECT e.page_id,
         list(CAST(CASE WHEN nr.nrm > 0 THEN CAST(coalesce(c.n, 0) AS DOUBLE) / nr.nrm ELSE 0.0 END AS FLOAT)
              ORDER BY r.i) AS value, CAST(NULL AS VARCHAR) AS error, 'SUCCESS' AS status
  FROM {p}_eq e CROSS JOIN range(768) r(i)
  LEFT JOIN {p}_cnt c ON c.page_id = e.page_id AND c.b = r.i
  LEFT JOIN {p}_nrm nr ON nr.page_id = e.page_id
  WHERE NOT e.is_blank GROUP BY e.page_id
  UNION ALL
  SELECT page_id, CAST(NULL AS FLOAT[]), 'text to embed is empty', 'FAILED' FROM {p}_eq WHERE is_blank)""",
    ]


_PAGE_COLS = ("page_id, doc_id, page_number, gcs_path, gcs_pdf_path, extracted_text, summary, embedding, "
              "extracted, summarized, embedded, indexed, error_message, status, created_at, updated_at")


def _patch(out: str, state: str, res: str, stage: str, value_col: str | None) -> str:
    """One stage's results applied to the state: NULL values leave the old ones."""
    cols = []
    for c in [x.strip() for x in _PAGE_COLS.split(",")]:
        if c == stage:
            cols.append(f"coalesce(r.status, s.{c}) AS {c}")
        elif c == value_col:
            cols.append(f"coalesce(r.value, s.{c}) AS {c}")
        elif c == "error_message":
            cols.append(f"coalesce(r.error, s.{c}) AS {c}")
        elif c == "updated_at":
            cols.append(f"CASE WHEN r.page_id IS NOT NULL THEN {RUN} ELSE s.{c} END AS {c}")
        else:
            cols.append(f"s.{c}")
    return f"{out} AS (SELECT {', '.join(cols)} FROM {state} s LEFT JOIN {res} r ON r.page_id = s.page_id)"


_PIPE = [
    _FLIPPED.replace("LEFT JOIN synced r", "LEFT JOIN strict_reg r"),
    f"""synced_pages AS (SELECT page_id, doc_id, page_number, gcs_path, gcs_pdf_path, extracted_text, summary,
  embedding, extracted, summarized, embedded, indexed, error_message,
  CASE WHEN flip THEN d_status ELSE status END AS status, created_at,
  CASE WHEN flip THEN {RUN} ELSE updated_at END AS updated_at FROM flipped)""",
    """todo AS (SELECT doc_id, path FROM strict_reg
  WHERE status = 'ACTIVE' AND doc_id NOT IN (SELECT doc_id FROM synced_pages))""",
    "docs_in AS (SELECT t.doc_id, t.path, s.content FROM todo t JOIN storage s ON s.path = t.path)",
    _SPLIT_ALL,
    _PAY.replace("pay AS", "old_pay AS"),
    """pay AS (SELECT page_id, doc_id, page_number, gcs_pdf_path, text FROM old_pay
  WHERE page_id NOT IN (SELECT page_id FROM split_all)
  UNION ALL SELECT page_id, doc_id, page_number, gcs_pdf_path, text FROM split_all)""",
    f"""st0 AS (SELECT * FROM synced_pages UNION ALL
  SELECT page_id, doc_id, page_number, gcs_path, gcs_pdf_path, NULL, NULL, CAST(NULL AS FLOAT[]),
         'PENDING', 'PENDING', 'PENDING', 'PENDING', NULL, 'ACTIVE', {RUN}, {RUN}
  FROM split_all WHERE page_id NOT IN (SELECT page_id FROM synced_pages))""",
    f"""ex_res AS (SELECT q.page_id, {chain('y.text')} AS value, CAST(NULL AS VARCHAR) AS error, 'SUCCESS' AS status
  FROM (SELECT page_id FROM st0 WHERE {QUEUE['extract']}) q JOIN pay y ON y.page_id = q.page_id)""",
    _patch("st1", "st0", "ex_res", "extracted", "extracted_text"),
    f"su_q AS (SELECT page_id FROM st1 WHERE {QUEUE['summary']})",
    *_situate_ctes("su", "su_q", "pay"),
    _patch("st2", "st1", "su_res", "summarized", "summary"),
    f"em_q AS (SELECT * FROM st2 WHERE {QUEUE['embed']})",
    *_embed_ctes("em", "em_q"),
    _patch("st3", "st2", "em_res", "embedded", "embedding"),
]

ORACLE["run_pipeline"] = q(f"""
SELECT page_id, doc_id, {sql_pad5('page_number')} AS page_number, status, gcs_path, gcs_pdf_path,
       extracted_text, summary, embedding, 'hashed-bow-768' AS model
FROM st3 WHERE {QUEUE['index']} AND embedding IS NOT NULL""",
    *_STRICT,
    ORACLE["apply_changes_strict"].split("acts AS (", 1)[0] and "acts AS (" + ORACLE["apply_changes_strict"].split("acts AS (", 1)[1].split("\nSELECT doc_id, path, content_hash, status, created_at, updated_at FROM strict_reg")[0],
    *_PIPE)
