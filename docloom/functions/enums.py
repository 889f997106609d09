"""Open string enums: known values are recognised, unknown ones are kept.

A value outside the known set is never dropped or rewritten.  It is flagged,
equals no known member, and so counts as "not terminal" and "not ready".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the document model.
DOCUMENT_STATUSES = ("uploading", "processing", "ready")
JOB_STATUSES = ("running", "completed", "failed", "partial_success", "creating_workflows")
TERMINAL_JOB_STATUSES = ("completed", "failed", "partial_success")
DATA_TYPES = ("String", "Number", "Boolean", "Date")
STEPS = ("splitter", "classifier", "extractor")
DUPLICATE_POLICIES = ("allow", "notify", "block")


def is_known(value: Column, known: tuple[str, ...]) -> Column:
    """True for a known value, false for any other string, null for null."""
    return value.isin(*known)


def is_terminal(status: Column) -> Column:
    return F.coalesce(status.isin(*TERMINAL_JOB_STATUSES), F.lit(False))


def is_ready(status: Column) -> Column:
    return F.coalesce(status == F.lit("ready"), F.lit(False))


def normalize_enum(df: DataFrame, column: str, known: tuple[str, ...]) -> DataFrame:
    """Add ``<column>_is_known``; a column that is not a string is an error."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.StringType):
        raise TypeError(f"{column} must be a string column, not {kind.simpleString()}")
    return df.withColumn(f"{column}_is_known", is_known(F.col(column), known))
