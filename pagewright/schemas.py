"""Fixed table schemas and status values."""

from __future__ import annotations

from pyspark.sql import types as T

# Status enums of the document, page and run tables.
ACTIVE, INACTIVE = "ACTIVE", "INACTIVE"
PENDING, SUCCESS, FAILED = "PENDING", "SUCCESS", "FAILED"
IDLE, RUNNING, COMPLETED = "IDLE", "RUNNING", "COMPLETED"
DOC_STATUSES = (ACTIVE, INACTIVE)
PAGE_STATUSES = (PENDING, SUCCESS, FAILED)
RUN_STATUSES = (IDLE, RUNNING, COMPLETED, FAILED)

# The four per-page stage columns, in pipeline order.
STAGES = ("extracted", "summarized", "embedded", "indexed")

# Fixed value: embedding width of the reference model.
EMBED_DIM = 768
# Fixed value: number of leading pages used as document context.
CONTEXT_PAGES = 5

SCAN = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("content_hash", T.StringType(), False),
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("length", T.LongType(), True),
])

SCAN_ERRORS = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("error", T.StringType(), True),
])

DOCUMENTS_STATE = T.StructType([
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("content_hash", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
])

PAGES_STATE = T.StructType([
    T.StructField("page_id", T.StringType(), False),
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("page_number", T.IntegerType(), False),
    T.StructField("gcs_path", T.StringType(), False),
    T.StructField("gcs_pdf_path", T.StringType(), False),
    T.StructField("extracted_text", T.StringType(), True),
    T.StructField("summary", T.StringType(), True),
    T.StructField("embedding", T.ArrayType(T.FloatType()), True),
    T.StructField("extracted", T.StringType(), True),
    T.StructField("summarized", T.StringType(), True),
    T.StructField("embedded", T.StringType(), True),
    T.StructField("indexed", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
])

# Columns a patch may set; every one nullable, NULL means "leave as is".
PATCHABLE = ("extracted_text", "summary", "embedding", "extracted", "summarized",
             "embedded", "indexed", "error_message", "status")

PAGE_PATCH = T.StructType(
    [T.StructField("page_id", T.StringType(), False),
     T.StructField("seq", T.LongType(), False)]
    + [T.StructField(f.name, f.dataType, True) for f in PAGES_STATE.fields if f.name in PATCHABLE]
    + [T.StructField("updated_at", T.TimestampNTZType(), True)]
)

RUN_LOG = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("status", T.StringType(), True),
    T.StructField("stage", T.StringType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("total_documents", T.IntegerType(), True),
    T.StructField("processed_documents", T.IntegerType(), True),
    T.StructField("error_message", T.StringType(), True),
])

PAGE_INDEX = T.StructType([
    T.StructField("page_id", T.StringType(), False),
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("page_number", T.StringType(), False),
    T.StructField("status", T.StringType(), True),
    T.StructField("gcs_path", T.StringType(), True),
    T.StructField("gcs_pdf_path", T.StringType(), True),
    T.StructField("extracted_text", T.StringType(), True),
    T.StructField("summary", T.StringType(), True),
    T.StructField("embedding", T.ArrayType(T.FloatType()), True),
    T.StructField("model", T.StringType(), True),
])

TABLES = {
    "documents_state": DOCUMENTS_STATE,
    "pages_state": PAGES_STATE,
    "run_log": RUN_LOG,
    "page_index": PAGE_INDEX,
}
