"""Table schemas of the document model."""

from __future__ import annotations

from pyspark.sql import types as T

#: 23 fraction digits keep every digit the model's numbers carry; that leaves
#: 15 integer digits.  Wider numbers are flagged, never rounded.
NUMBER_SCALE = 23
NUMBER = T.DecimalType(38, NUMBER_SCALE)


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_long, _str, _bool, _ts = T.LongType(), T.StringType(), T.BooleanType(), T.TimestampType()
_double, _int = T.DoubleType(), T.IntegerType()

DOCUMENTS = _table(
    ("id", _long),
    ("organization_id", _str),
    ("name", _str),
    ("status", _str),
    ("is_valid", _bool),
    ("created_at", _ts),
    ("has_active_workflow", _bool),
    ("file_size", _long),
    ("page_count", _long),
    ("source_document", _long),
    ("folder_id", _long),
    ("document_class", _str),
    ("document_subclass", _str),
)

BBOX = _table(("top", _double), ("left", _double), ("width", _double), ("height", _double))

TRACEBACK_ITEM = _table(
    ("bbox", BBOX), ("page", _long), ("confidence", _double), ("issues", T.ArrayType(_str))
)

#: One row per (document, prompt); ``position`` is the item's place in the
#: document's result list, which decides between repeated prompts.
EXTRACTION_RESULTS = _table(
    ("document_id", _long),
    ("position", _int),
    ("prompt_id", _long),
    ("name", _str),
    ("data_type", _str),
    ("display_type", _str),
    ("group_name", _str),
    ("parsed_value", T.VariantType()),
    ("value_text", _str),
    ("value_number", NUMBER),
    ("value_bool", _bool),
    ("value_date", T.DateType()),
    ("raw_value", _str),
    ("traceback", T.ArrayType(TRACEBACK_ITEM)),
    ("issues", T.ArrayType(_str)),
    ("readability", _double),
    ("is_processing", _bool),
)

FOLDERS = _table(
    ("id", _long),
    ("organization_id", _str),
    ("name", _str),
    ("parent_id", _long),
    ("created_at", _ts),
    ("updated_at", _ts),
)

PROJECTS = _table(("id", _long), ("organization_id", _str), ("name", _str), ("created_at", _ts))

PROJECT_DOCUMENTS = _table(("project_id", _long), ("document_id", _long), ("created_at", _ts))

TAGS = _table(("id", _long), ("name", _str))

DOCUMENT_TAGS = _table(("document_id", _long), ("tag_id", _long), ("tagged_at", _ts))

PROMPTS = _table(
    ("id", _long),
    ("organization_id", _str),
    ("name", _str),
    ("description", _str),
    ("data_type", _str),
    ("display_type", _str),
    ("group_name", _str),
    ("example", T.VariantType()),
    ("document_class", _str),
    ("deleted", _bool),
    ("created_at", _ts),
    ("updated_at", _ts),
)

JOBS = _table(
    ("id", _long),
    ("organization_id", _str),
    ("organization_name", _str),
    ("total_docs", _long),
    ("completed_docs", _long),
    ("error_count", _long),
    ("status", _str),
    ("stages", T.ArrayType(_str)),
    ("created_at", _ts),
    ("project_id", _long),
    ("selectors", _str),
    ("credits", _long),
)

JOB_DOCUMENTS = _table(("job_id", _long), ("document_id", _long), ("status", _str))

CREDIT_ESTIMATES = _table(
    ("estimate_id", _str), ("step", _str), ("total_credits", _long), ("page_count", _long),
    ("document_count", _long),
)

#: What an incoming file looks like before it is planned.
FILE_MANIFEST = _table(
    ("file_name", _str), ("content_type", _str), ("size", _long), ("md5", _str)
)

UPLOAD_ERROR = _table(
    ("code", _str), ("message", _str), ("file_size", _long), ("max_size", _long),
    ("retryable", _bool),
)

DUPLICATE = _table(
    ("document_id", _long), ("name", _str), ("file_size", _long), ("page_count", _long),
    ("created_at", _ts),
)

UPLOAD_OUTCOMES = _table(
    ("file_name", _str),
    ("document_id", _long),
    ("uploaded", _bool),
    ("skipped_as_duplicate", _bool),
    ("duplicate_count", _long),
    ("error", UPLOAD_ERROR),
)

#: One status observation of a document or job.
STATUS_EVENTS = _table(("subject_id", _long), ("status", _str), ("ts", _ts))
