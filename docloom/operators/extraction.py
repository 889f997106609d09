"""Extraction results: running prompts, flattening, pivoting and auditing.

The result table has one row per (document, prompt) item, see
``schemas.EXTRACTION_RESULTS``.  Work is per row or keyed by document and
prompt with partial aggregation, so one document or prompt with very many rows
does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Literal

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.patterns import may_match, need_of
from docloom.functions.values import (
    DATE_FORMATS,
    display_value,
    fields_of,
    number_overflow,
    typed_fields,
    typed_fields_by_column,
    value_type,
)
from docloom.operators.joins import one_to_many, settled
from docloom.schemas import NUMBER_SCALE

KeyBy = Literal["name", "prompt_id"]


@dataclass(frozen=True)
class ExtractRule:
    """A prompt answered by the first match of a pattern (``group`` of it)."""

    prompt_id: int
    name: str | None
    data_type: str
    pattern: str
    group: int = 0


# ----- producing results ---------------------------------------------------------


def answer_documents(
    documents: DataFrame,
    rules: Sequence[ExtractRule],
    *,
    text_col: str = "text",
    id_col: str = "id",
    keep_unanswered: bool = False,
    spread: int | None = None,
) -> DataFrame:
    """One row per document: ``document_id, has_text, answers``.

    Texts are scanned in one pass, without a shuffle, and do not travel further.  A rule
    runs only over texts that hold the literal its pattern needs; the literals of many
    rules are looked for at once (``functions/patterns.py``).  ``answers`` holds rule
    position and raw text.  ``spread`` deals the texts to that many tasks first, for
    inputs whose files cannot be split (it moves the texts).
    """
    text = F.col(text_col)
    wanted = documents.select(F.col(id_col).alias("document_id"), text_col)
    if spread:
        wanted = wanted.repartition(spread)
    wanted, may = may_match(wanted, text_col, [r.pattern for r in rules])
    found = []
    for rule, condition in zip(rules, may, strict=True):
        hit = F.regexp_extract(text, rule.pattern, rule.group)
        if rule.group == 0 and need_of(rule.pattern).never_empty:
            found.append(F.when(condition, F.nullif(hit, F.lit(""))))
        else:  # an empty hit is an answer if the pattern matched
            found.append(F.when(condition & text.rlike(rule.pattern), hit))
    hits = F.array(*found) if rules else F.expr("cast(array() as array<string>)")
    answers = F.transform(
        F.col("found"),
        lambda hit, place: F.struct(place.cast("int").alias("position"), hit.alias("raw_value")),
    )
    if not keep_unanswered:
        answers = F.filter(answers, lambda item: item["raw_value"].isNotNull())
    judged = wanted.select("document_id", text.isNotNull().alias("has_text"), hits.alias("found"))
    return judged.select("document_id", "has_text", answers.alias("answers"))


def explode_answers(
    answered: DataFrame,
    rules: Sequence[ExtractRule],
    *,
    scale: int = NUMBER_SCALE,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Typed result rows out of :func:`answer_documents`."""
    def per_rule(values: list, kind: str) -> Column:
        table = F.array(*[F.lit(value).cast(kind) for value in values])
        return F.element_at(table, F.col("item.position") + 1)

    # The outer form, because for a plain explode the optimizer filters on the size of
    # the array below it, which would run all patterns a second time.
    exploded = answered.select("document_id", F.explode_outer("answers").alias("item"))
    rows = exploded.where(F.col("item").isNotNull()).select(
        "document_id",
        "item.position",
        per_rule([r.prompt_id for r in rules], "long").alias("prompt_id"),
        per_rule([r.name for r in rules], "string").alias("name"),
        per_rule([r.data_type for r in rules], "string").alias("data_type"),
        "item.raw_value",
    )
    # The data types are known here, so only the needed parsers enter the plan.
    columns: dict[str, Column] = {}
    for kind in dict.fromkeys(rule.data_type for rule in rules):
        typed = typed_fields(F.col("raw_value"), kind, scale=scale, date_formats=date_formats)
        for name, expr in typed.items():
            guarded = F.when(F.col("data_type") == kind, expr)
            columns[name] = F.coalesce(columns[name], guarded) if name in columns else guarded
    return _with_overflow(rows.withColumns(columns))


def _with_overflow(typed: DataFrame) -> DataFrame:
    flag = number_overflow(F.col("data_type"), F.col("value_number"), F.col("raw_value"))
    return typed.withColumn("number_overflow", flag)


def run_extractor(
    documents: DataFrame,
    rules: Sequence[ExtractRule],
    *,
    text_col: str = "text",
    id_col: str = "id",
    keep_unanswered: bool = False,
    scale: int = NUMBER_SCALE,
    date_formats: Sequence[str] = DATE_FORMATS,
    spread: int | None = None,
) -> DataFrame:
    """Run every rule over every whole text in one pass, and type the answers.

    A rule without a match gives no row, or a row without value when
    ``keep_unanswered``.  For ``spread`` see :func:`answer_documents`.
    """
    answered = answer_documents(
        documents, rules, text_col=text_col, id_col=id_col, keep_unanswered=keep_unanswered, spread=spread
    )
    return explode_answers(answered, rules, scale=scale, date_formats=date_formats)


def type_raw_values(
    results: DataFrame, *, scale: int = NUMBER_SCALE, date_formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Fill the typed columns of a result table from ``raw_value`` and ``data_type``."""
    typed = typed_fields_by_column(
        F.col("raw_value"), F.col("data_type"), scale=scale, date_formats=date_formats
    )
    return _with_overflow(results.withColumns(typed))


#: A user extractor: texts in, one raw answer (or None) per text.
UserExtractor = Callable[[pd.Series], Iterable[str | None]]


def run_user_extractor(
    documents: DataFrame,
    extractors: dict[int, tuple[str | None, str, UserExtractor]],
    *,
    text_col: str = "text",
    id_col: str = "id",
) -> DataFrame:
    """Like :func:`run_extractor` with user functions, called per Arrow batch.

    ``extractors`` maps a prompt id to (name, data type, function).
    """
    schema = (
        "document_id long, position int, prompt_id long, name string, data_type string, "
        "raw_value string"
    )

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for position, (prompt_id, (name, kind, function)) in enumerate(extractors.items()):
                raw = pd.Series(list(function(batch["text"])), index=batch.index, dtype="object")
                found = raw.notna()
                yield pd.DataFrame(
                    {
                        "document_id": batch["id"][found],
                        "position": position,
                        "prompt_id": prompt_id,
                        "name": name,
                        "data_type": kind,
                        "raw_value": raw[found],
                    }
                )

    source = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return type_raw_values(source.mapInPandas(answer, schema))


@dataclass(frozen=True)
class ClassRule:
    """Texts that match ``pattern`` score ``weight`` for a class."""

    document_class: str
    pattern: str
    weight: int = 1
    document_subclass: str | None = None


def run_classifier(
    documents: DataFrame, rules: Sequence[ClassRule], *, text_col: str = "text", spread: int | None = None
) -> DataFrame:
    """Set ``document_class`` and ``document_subclass`` to the best-scoring class.

    Ties go to the class that the rules name first; no hit leaves both null.
    The scores are columns of the row, so nothing is joined or shuffled; like for
    :func:`answer_documents`, patterns run over texts that hold their literal, and ``spread``
    deals the documents to that many tasks first.
    """
    if spread:
        documents = documents.repartition(spread)
    documents, may = may_match(documents, text_col, [r.pattern for r in rules])
    classes = list(dict.fromkeys((r.document_class, r.document_subclass) for r in rules))
    candidates = []
    for rank, (name, subclass) in enumerate(classes):
        score = F.lit(0)
        for rule, condition in zip(rules, may, strict=True):
            if (rule.document_class, rule.document_subclass) == (name, subclass):
                hits = condition & F.col(text_col).rlike(rule.pattern)
                score = score + hits.cast("int") * rule.weight
        candidates.append(
            F.struct(
                score.alias("score"),
                F.lit(-rank).alias("rank"),
                F.lit(name).alias("name"),
                F.lit(subclass).cast("string").alias("subclass"),
            )
        )
    best = F.array_max(F.array(*candidates))
    hit = F.col("__best.score") > 0
    return (
        documents
        .withColumn("__best", best)
        .withColumn("document_class", F.when(hit, F.col("__best.name")))
        .withColumn("document_subclass", F.when(hit, F.col("__best.subclass")))
        .drop("__best", "__may")
    )


def run_user_classifier(
    documents: DataFrame,
    classify: Callable[[pd.Series], pd.DataFrame],
    *,
    text_col: str = "text",
) -> DataFrame:
    """Set class and subclass by a user function.

    ``classify`` gets a series of texts and returns a frame with the columns
    ``document_class`` and ``document_subclass`` in the same order.
    """
    kind = "document_class string, document_subclass string"

    def labels(texts: pd.Series) -> pd.DataFrame:
        return classify(texts)[["document_class", "document_subclass"]]

    udf = F.pandas_udf(labels, kind)
    return (
        documents.withColumn("__label", udf(F.col(text_col)))
        .withColumn("document_class", F.col("__label.document_class"))
        .withColumn("document_subclass", F.col("__label.document_subclass"))
        .drop("__label")
    )


def run_splitter(
    documents: DataFrame,
    boundary: str,
    *,
    first_id: int,
    stride: int | None = None,
    text_col: str = "text",
    id_col: str = "id",
) -> DataFrame:
    """Cut each text at a boundary pattern into child documents.

    Child ids are ``first_id + source * stride + position``: no shuffle of texts, and
    the same on every run.  ``first_id`` must lie above all existing ids.  Blank pieces
    make no child.  Without ``stride`` it is the largest number of pieces of a text
    (runs a job), so that no text has too many; ids that would not fit a long are an
    error before anything is split.
    """
    size = F.max(F.size(F.split(F.col(text_col), boundary, -1)))
    if stride is None:
        found = documents.agg(size.alias("pieces"), F.max(id_col).alias("last")).first()
        stride = max(found["pieces"] or 1, 1)
        if first_id + ((found["last"] or 0) + 1) * stride >= 1 << 63:
            raise ValueError("child ids would not fit a long; number the sources anew")
    pieces = documents.select(
        F.col(id_col).alias("source_document"),
        # Outer, like above: the plain form would split every text twice.
        F.posexplode_outer(F.split(F.col(text_col), boundary, -1)).alias("position", text_col),
    ).where(F.trim(F.col(text_col)) != "")
    child = F.lit(first_id).cast("long") + F.col("source_document") * stride + F.col("position")
    too_many = F.raise_error(
        F.concat(F.lit("too many splits in document "), F.col("source_document").cast("string"))
    )
    return pieces.select(
        F.when(F.col("position") < stride, child).otherwise(too_many.cast("long")).alias("id"),
        "source_document",
        "position",
        text_col,
    )


# ----- reading results -------------------------------------------------------------


def with_value_type(results: DataFrame) -> DataFrame:
    """Add ``value_type`` and the text rendering ``value``."""
    columns = fields_of(results.schema)
    return results.withColumns(
        {"value_type": value_type(columns), "value": display_value(columns)}
    )


def drop_pending(results: DataFrame) -> DataFrame:
    """Leave out items that are processing and have neither raw text nor value."""
    if "is_processing" not in results.columns:
        return results
    empty = F.col("raw_value").isNull() & value_type(fields_of(results.schema)).isNull()
    pending = F.coalesce(F.col("is_processing"), F.lit(False)) & empty
    return results.where(~pending)


def with_field_key(results: DataFrame, key_by: KeyBy = "name") -> DataFrame:
    """Add ``key_kind`` and ``field_key``.

    A prompt named ``6`` and the unnamed prompt 6 are different fields; the kind
    tells them apart.
    """
    if key_by not in ("name", "prompt_id"):
        raise ValueError(f"key_by must be name or prompt_id, not {key_by!r}")
    number = F.col("prompt_id").cast("string")
    if key_by == "prompt_id":
        return results.withColumns({"key_kind": F.lit("prompt_id"), "field_key": number})
    by_name = F.col("name").isNotNull() & (F.col("name") != "")
    return results.withColumns(
        {
            "key_kind": F.when(by_name, "name").otherwise("prompt_id"),
            "field_key": F.when(by_name, F.col("name")).otherwise(number),
        }
    )


def key_collisions(keyed: DataFrame) -> DataFrame:
    """Fields that two items of one document share: an error for flattening by name."""
    return (
        keyed.groupBy("document_id", "key_kind", "field_key")
        .agg(
            F.count("*").alias("items"),
            F.min("prompt_id").alias("first_prompt_id"),
            F.max("prompt_id").alias("last_prompt_id"),
        )
        .where(F.col("items") > 1)
    )


def distinct_keys(rules: Sequence[ExtractRule], key_by: KeyBy = "name") -> bool:
    """Do no two rules share a field?  Then no document can have a field twice."""
    by_id = [("prompt_id", str(r.prompt_id)) for r in rules]
    keys = by_id if key_by == "prompt_id" else [("name", r.name) if r.name else k for r, k in zip(rules, by_id, strict=True)]
    return len(set(keys)) == len(keys)


def _without_collisions(keyed: DataFrame) -> DataFrame:
    """The same rows; a field that repeats in a document is an error when its rows are computed."""
    # One value, so that the rows are dealt by all three: by the document alone a hot one could not be split.
    place = F.struct("document_id", "key_kind", "field_key")
    items = F.count("*").over(Window.partitionBy(place))
    clash = F.raise_error(
        F.concat(
            F.lit("field "), F.col("field_key"), F.lit(" appears "), F.col("__items").cast("string"),
            F.lit(" times on document "), F.col("document_id").cast("string"),
            F.lit("; flatten with key_by='prompt_id' instead"),
        )
    )
    # A filter, because a column that nobody reads would not be computed.
    repeats = (F.col("__items") > 1) & F.col("field_key").isNotNull()
    checked = keyed.withColumn("__items", items).where(F.when(repeats, clash.cast("boolean")).otherwise(True))
    return checked.drop("__items")


def flatten_values(
    results: DataFrame,
    *,
    documents: DataFrame | None = None,
    key_by: KeyBy = "name",
    strict: bool = True,
    rules: Sequence[ExtractRule] | None = None,
) -> DataFrame:
    """Long rows ``document_id, key_kind, field_key, prompt_id, value_type, value, …``.

    Pending items are left out first.  With ``documents`` (their distinct ``id`` column),
    documents without items stay as one row with a null field.  A field key that
    repeats inside a document is an error of the query that reads the rows: they are counted
    per document and field on their way, in the same evaluation of ``results``.  Nothing needs
    to be counted if ``rules``, by which ``results`` were extracted from documents of distinct
    ids, have distinct fields, nor before :func:`pivot_values`, which checks by itself
    (``strict=False``).
    """
    keyed = with_value_type(with_field_key(drop_pending(results), key_by))
    check = strict and not (rules is not None and distinct_keys(rules, key_by))
    wanted = ["document_id", "key_kind", "field_key", "prompt_id", "value_type", "value"]
    typed = ["value_text", "value_number", "value_bool", "value_date"]
    extra = ["parsed_value"] if "parsed_value" in keyed.columns else []
    flat = keyed.select(*wanted, *typed, *extra)
    if documents is not None:
        ids = documents.select(F.col("id").alias("document_id"))
        flat = one_to_many(ids, flat, "document_id")
    # Behind the join, which can split a document with very many items.
    return _without_collisions(flat) if check else flat


def field_columns(flat: DataFrame, *, max_fields: int = 10_000) -> list[tuple[str, str]]:
    """The distinct (key kind, field key) pairs, sorted (runs a job).

    Their number is bounded by the prompts; beyond ``max_fields`` this raises
    instead of collecting.
    """
    rows = (
        flat.where(F.col("field_key").isNotNull())
        .select("key_kind", "field_key")
        .distinct()
        .limit(max_fields + 1)
        .collect()
    )
    if len(rows) > max_fields:
        raise ValueError(f"more than {max_fields} fields; export long rows instead")
    return sorted(((r["key_kind"], r["field_key"]) for r in rows), key=lambda p: (p[1], p[0]))


def pivot_values(flat: DataFrame, fields: Sequence[str | tuple[str, str]]) -> DataFrame:
    """One row per document with one text column per field, null where missing.

    ``fields`` are field names, or (kind, key) pairs.  Where a prompt's name
    equals another prompt's id, the latter's column is called ``<id>#id``.  All
    columns come out of one aggregation with a single shuffle on the document, which
    also raises when two items of a document share a column.
    """
    pairs = [("name", f) if isinstance(f, str) else f for f in fields]
    names = {key for kind, key in pairs if kind == "name"}
    cells = []
    for kind, key in pairs:
        here = (F.col("key_kind") == kind) & (F.col("field_key") == key)
        label = f"{key}#id" if kind == "prompt_id" and key in names else key
        clash = F.raise_error(
            F.concat(
                F.lit(f"field {label!r} appears more than once on document "),
                F.col("document_id").cast("string"),
                F.lit("; flatten with key_by='prompt_id' instead"),
            )
        ).cast("string")
        value = F.max(F.when(here, F.col("value")))
        cells.append(F.when(F.count_if(here) > 1, clash).otherwise(value).alias(label))
    if not cells:
        return flat.select("document_id").distinct()
    return flat.groupBy("document_id").agg(*cells)


def last_per_prompt(results: DataFrame) -> DataFrame:
    """One item per (document, prompt): of repeated prompts the last one counts."""
    others = [c for c in results.columns if c not in ("document_id", "prompt_id")]
    newest = F.max_by(F.struct(*others), F.col("position")).alias("item")
    return results.groupBy("document_id", "prompt_id").agg(newest).select(
        "document_id", "prompt_id", "item.*"
    )


def attach_results(
    documents: DataFrame, results: DataFrame, prompts: Sequence[int] | None
) -> DataFrame:
    """Documents with the items of the requested prompts as long rows.

    Without prompts nothing is joined and the documents come back as they are.
    """
    if not prompts:
        return documents
    wanted = results.where(F.col("prompt_id").isin(*prompts)).withColumnsRenamed(
        {"document_id": "id", "name": "prompt_name"}
    )
    return one_to_many(documents, wanted, "id")


def nest_results(
    documents: DataFrame, results: DataFrame, prompts: Sequence[int] | None
) -> DataFrame:
    """Documents with an ``extraction_results`` array in the item order.

    Repeated prompts are reduced to their last item first, so an array is never
    longer than the list of requested prompts.
    """
    if not prompts:
        return documents
    items = last_per_prompt(results.where(F.col("prompt_id").isin(*prompts)))
    value = [c for c in items.columns if c not in ("document_id", "prompt_id", "position")]
    item = F.struct("position", "prompt_id", F.struct(*value).alias("value"))
    by_place = lambda a, b: F.when(a["position"] < b["position"], -1).when(
        a["position"] > b["position"], 1
    ).otherwise(0)
    nested = items.groupBy("document_id").agg(F.collect_list(item).alias("__items"))
    ordered = F.transform(
        F.array_sort("__items", by_place), lambda i: F.struct(i["prompt_id"], i["value"])
    )
    nested = nested.select("document_id", ordered.alias("extraction_results"))
    joined = documents.join(nested, documents["id"] == nested["document_id"], "left")
    return joined.drop("document_id")


def with_pending_placeholders(
    documents: DataFrame, results: DataFrame, prompts: Sequence[int]
) -> DataFrame:
    """Items of the requested prompts, plus a placeholder per running prompt without one.

    Results of other documents than the given ones are left out.  Only documents with
    a running workflow are expanded by the prompt list.
    """
    known = documents.select(F.col("id").alias("document_id")).distinct()
    wanted = results.where(F.col("prompt_id").isin(*prompts)).join(settled(known), "document_id", "left_semi")
    if "is_processing" not in wanted.columns:
        wanted = wanted.withColumn("is_processing", F.lit(False))
    requested = F.array(*[F.lit(p).cast("long") for p in prompts])
    waiting = (
        documents.where(F.col("has_active_workflow"))
        .select(F.col("id").alias("document_id"), F.explode(requested).alias("prompt_id"))
        .join(
            wanted.select("document_id", "prompt_id").distinct(), ["document_id", "prompt_id"], "left_anti"
        )
        .withColumn("is_processing", F.lit(True))
    )
    return wanted.unionByName(waiting, allowMissingColumns=True)


def traceback_rows(results: DataFrame) -> DataFrame:
    """Audit rows: one per traceback item, and one for an item without any."""
    item = F.col("item")
    return results.select(
        "document_id", "prompt_id", F.posexplode_outer("traceback").alias("item_no", "item")
    ).select(
        "document_id",
        "prompt_id",
        "item_no",
        item["page"].alias("page"),
        item["confidence"].alias("confidence"),
        item["bbox"]["top"].alias("top"),
        item["bbox"]["left"].alias("left"),
        item["bbox"]["width"].alias("width"),
        item["bbox"]["height"].alias("height"),
        item["issues"].alias("issues"),
    )


def traceback_issues(results: DataFrame) -> DataFrame:
    """One row per issue text of a traceback item."""
    return traceback_rows(results).select(
        "document_id", "prompt_id", "item_no", "page", F.explode("issues").alias("issue")
    )

