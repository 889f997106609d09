"""JSON page dumps ``{items, page, page_size, has_more}`` as entity tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = "items array<variant>, page long, page_size long, has_more boolean"

#: Second spellings of fields on the wire (fixed values).
ALIASES = {
    "created_at": "createdAt",
    "top": "Top",
    "left": "Left",
    "width": "Width",
    "height": "Height",
}


def read_pages(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """The pages of a dump, one per row; items stay variants, so no field is lost."""
    return spark.read.schema(ENVELOPE).option("multiLine", multi_line).json(path)


def page_items(pages: DataFrame) -> DataFrame:
    """``page, item_no, item`` up to and including the first page with ``has_more`` false."""
    last = pages.where(~F.col("has_more")).agg(F.min("page"))
    upto = F.coalesce(last.scalar(), F.lit(2**63 - 1))
    return pages.where(F.col("page") <= upto).select(
        "page", F.posexplode("items").alias("item_no", "item")
    )


def page_completeness(pages: DataFrame) -> DataFrame:
    """One row: are the pages 1..N all there, once, and is only page N the last?"""
    ends = ~F.col("has_more")
    facts = pages.agg(
        F.count("*").alias("pages"),
        F.count_distinct("page").alias("distinct_pages"),
        F.min("page").alias("first_page"),
        F.max("page").alias("last_page"),
        F.count_if(ends).alias("ends"),
        F.min(F.when(ends, F.col("page"))).alias("end_page"),
    )
    complete = (
        (F.col("first_page") == 1)
        & (F.col("pages") == F.col("last_page"))
        & (F.col("distinct_pages") == F.col("pages"))
        & (F.col("ends") == 1)
        & (F.col("end_page") == F.col("last_page"))
    )
    return facts.withColumn("is_complete", F.coalesce(complete, F.lit(False)))


def _field(item: Column, name: str, kind: T.DataType) -> Column:
    """One declared field, in whichever spelling it came; null when it does not fit."""
    if isinstance(kind, T.VariantType):
        read = lambda key: F.try_variant_get(item, f"$['{key}']", "variant")
    elif isinstance(kind, T.StructType):
        inner = F.try_variant_get(item, f"$['{name}']", "variant")
        return F.when(inner.isNotNull(), _record(inner, kind))
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        array = F.try_variant_get(item, f"$['{name}']", "array<variant>")
        return F.transform(array, lambda v: _record(v, kind.elementType))
    elif isinstance(kind, T.TimestampType):
        read = lambda key: F.try_to_timestamp(
            F.try_variant_get(item, f"$['{key}']", "string")
        )
    elif isinstance(kind, T.DateType):
        read = lambda key: F.to_date(
            F.try_to_timestamp(F.try_variant_get(item, f"$['{key}']", "string"))
        )
    elif isinstance(kind, T.DecimalType):
        read = lambda key: F.try_variant_get(item, f"$['{key}']", "string").try_cast(kind)
    else:
        read = lambda key: F.try_variant_get(item, f"$['{key}']", kind.simpleString())
    alias = ALIASES.get(name)
    return read(name) if alias is None else F.coalesce(read(alias), read(name))


def _record(item: Column, schema: T.StructType) -> Column:
    return F.struct(*[_field(item, f.name, f.dataType).alias(f.name) for f in schema.fields])


def typed_items(items: DataFrame, schema: T.StructType, *, extra: str = "_extra") -> DataFrame:
    """Declared fields as columns, every other field in the map ``_extra``.

    Fields on the wire keep their value whatever it is: the map is
    ``string -> variant``.
    """
    names = [f.name for f in schema.fields]
    spellings = names + [ALIASES[n] for n in names if n in ALIASES]
    fields = [_field(F.col("item"), f.name, f.dataType).alias(f.name) for f in schema.fields]
    rest = F.map_filter(
        F.col("item").cast("map<string,variant>"), lambda key, value: ~key.isin(*spellings)
    )
    return items.select(*fields, rest.alias(extra))


def extraction_items(items: DataFrame, schema: T.StructType) -> DataFrame:
    """Extraction rows out of document items: one per entry of ``extraction_results``.

    ``schema`` lists the fields of a value; ``document_id``, ``position`` and
    ``prompt_id`` are added from the document.
    """
    value_fields = [
        f for f in schema.fields if f.name not in ("document_id", "position", "prompt_id")
    ]
    results = F.try_variant_get("item", "$.extraction_results", "array<variant>")
    rows = items.select(
        F.try_variant_get("item", "$.id", "bigint").alias("document_id"),
        F.posexplode(results).alias("position", "result"),
    )
    value = F.try_variant_get("result", "$.value", "variant")
    return rows.select(
        "document_id",
        "position",
        F.try_variant_get("result", "$.prompt_id", "bigint").alias("prompt_id"),
        *[_field(value, f.name, f.dataType).alias(f.name) for f in value_fields],
    ).select(*schema.names)
