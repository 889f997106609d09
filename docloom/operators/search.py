"""Ordered search, paging and lookup over any entity table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_PAGE_SIZE = 50


def total_order(order_by: str = "id", order_dir: str = "asc", tie: str = "id") -> list[Column]:
    """Sort keys with nulls last and the id as tie-break."""
    if order_dir not in ("asc", "desc"):
        raise ValueError(f"order_dir must be asc or desc, not {order_dir!r}")
    column = F.col(order_by)
    first = column.asc_nulls_last() if order_dir == "asc" else column.desc_nulls_last()
    if order_by == tie:
        return [first]
    return [first, F.col(tie).asc()]


#: A page that ends within so many rows is taken from the first ones directly.
DIRECT_ROWS = 10_000
#: Ranges that a deep page is narrowed down by at a time, and sampled keys per range.
RANGES, SAMPLED = 64, 64
#: So many rows are sorted to cut a deep page out of its range.
MOST_SORTED = 200_000


def _after(order_by: str, order_dir: str, tie: str, value: Any, last: Any) -> Column:  # noqa: ANN401
    """Rows that follow the row with the keys ``value`` and ``last``."""
    column, tie_column = F.col(order_by), F.col(tie)
    if order_by == tie:
        return column > last if order_dir == "asc" else column < last
    if value is None:
        return column.isNull() & (tie_column > last)
    beyond = column > F.lit(value) if order_dir == "asc" else column < F.lit(value)
    return beyond | ((column == F.lit(value)) & (tie_column > last)) | column.isNull()


def search_page(
    matches: DataFrame,
    *,
    page: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
    order_by: str = "id",
    order_dir: str = "asc",
    tie: str = "id",
) -> DataFrame:
    """Rows of one 1-based page, with ``has_more`` on each row.

    One row past the page is looked at to learn ``has_more``.  A page that ends within
    DIRECT_ROWS rows is cut out of the first ones: every task keeps that many, nothing is
    sorted as a whole or written.  A deeper page is looked for by counting (runs jobs): the
    order is cut into RANGES ranges at sampled keys, rows are counted per range, and
    only the range that holds the page is cut further or sorted.  ``tie`` must identify a row.
    """
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size start at 1")
    first = (page - 1) * page_size
    skip = 0
    if first + page_size >= DIRECT_ROWS:
        matches, skip = _around(matches, first, first + page_size, order_by, order_dir, tie)
    order = total_order(order_by, order_dir, tie)
    top = matches.orderBy(*order).limit(first - skip + page_size + 1)
    place = F.row_number().over(Window.orderBy(*order)) + skip
    seen = top.withColumns({"__place": place, "__rows": F.count("*").over(Window.partitionBy()) + skip})
    rows = seen.where((F.col("__place") > first) & (F.col("__place") <= first + page_size))
    return rows.withColumn("has_more", F.col("__rows") > first + page_size).orderBy("__place").drop("__place", "__rows")


def _around(matches: DataFrame, start: int, stop: int, order_by: str, order_dir: str, tie: str) -> tuple[DataFrame, int]:
    """The rows of a range of the order that holds the places ``start`` to ``stop``, and how many come before it."""
    keys = matches.select(*dict.fromkeys([order_by, tie]))
    order = total_order(order_by, order_dir, tie)
    rows, before, inside = keys.count(), 0, F.lit(True)
    while rows > MOST_SORTED and before + rows > start:
        # About RANGES * SAMPLED keys come here, whatever the table.
        part = keys.where(inside)
        sample = part.sample(min(1.0, RANGES * SAMPLED / rows), seed=before + 1).orderBy(*order).limit(4 * RANGES * SAMPLED).collect()
        cuts = sample[:: max(1, len(sample) // RANGES)]
        later = [_after(order_by, order_dir, tie, cut[order_by], cut[tie]) for cut in cuts]
        number = sum((F.coalesce(c, F.lit(False)).cast("int") for c in later), F.lit(0))
        counts = dict(part.groupBy(number.alias("range")).agg(F.count("*").alias("n")).collect())
        low, high, skipped, wanted = 0, len(cuts), 0, 0
        while low < high and before + skipped + counts.get(low, 0) <= start:
            skipped += counts.get(low, 0)
            low += 1
        last = low
        wanted = counts.get(low, 0)
        while last < high and before + skipped + wanted <= stop:
            last += 1
            wanted += counts.get(last, 0)
        if wanted == rows:
            break  # the page itself fills the range
        if low > 0:
            inside = inside & later[low - 1]
        if last < len(cuts):
            inside = inside & ~F.coalesce(later[last], F.lit(False))
        before, rows = before + skipped, wanted
    return matches.where(inside), before


def search_after(
    matches: DataFrame,
    after: tuple[Any, Any] | None,
    *,
    page_size: int = DEFAULT_PAGE_SIZE,
    order_by: str = "id",
    order_dir: str = "asc",
    tie: str = "id",
) -> DataFrame:
    """The page that follows the row with keys ``after = (order value, tie value)``.

    Unlike page numbers, the cost does not grow with depth: the bound is a
    filter that reaches the scan.
    """
    if after is not None:
        later = _after(order_by, order_dir, tie, *after)
        matches = matches.where(later)
    return matches.orderBy(*total_order(order_by, order_dir, tie)).limit(page_size)


def iterate(
    matches: DataFrame, *, order_by: str = "id", order_dir: str = "asc", tie: str = "id"
) -> DataFrame:
    """Every match in order; walk it with ``toLocalIterator()`` if rows are needed one by one."""
    return matches.orderBy(*total_order(order_by, order_dir, tie))


def lookup(
    entities: DataFrame, wanted: DataFrame, *, key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Found entities and not-found ids for a one-column table of ids."""
    ids = wanted.select(F.col(wanted.columns[0]).alias(key)).distinct()
    found = entities.join(ids, key, "left_semi")
    missing = ids.join(entities.select(key), key, "left_anti")
    return found, missing


def fuzzy(column: Column, q: str, max_distance: int | None = None) -> Column:
    """Fuzzy name match: case-insensitive contains, or an edit distance bound."""
    contains = F.contains(F.lower(column), F.lower(F.lit(q)))
    if max_distance is None:
        return contains
    distance = F.levenshtein(F.lower(column), F.lower(F.lit(q)), max_distance)
    return contains | (distance >= 0)


#: Length of the grams that a name index holds.
GRAM = 2


def _grams(text: Column) -> Column:
    """The grams of a lower-cased text; those that repeat are numbered, so that they count as often as they stand there."""
    low = F.lower(text)
    starts = F.when(F.char_length(low) >= GRAM, F.sequence(F.lit(1), F.char_length(low) - (GRAM - 1)))
    plain = F.transform(starts, lambda i: F.substring(low, i, F.lit(GRAM)))
    return F.transform(
        plain, lambda g, i: F.concat(g, F.size(F.filter(F.slice(plain, F.lit(1), i), lambda h: h == g)).cast("string"))
    )


def name_index(entities: DataFrame, *, key: str = "id", column: str = "name") -> DataFrame:
    """The gram index of a name column: ``gram, key, size``, to be stored and read again by :func:`fuzzy_search`.

    Store it sorted or bucketed by ``gram``; a search reads the rows of its own grams.
    """
    size = F.char_length(F.lower(column)).alias("size")
    rows = entities.where(F.col(column).isNotNull()).select(F.col(key).alias("key"), size, F.explode(_grams(F.col(column))).alias("gram"))
    return rows.select("gram", "key", "size")


def fuzzy_search(
    entities: DataFrame,
    index: DataFrame,
    q: str,
    max_distance: int | None = None,
    *,
    key: str = "id",
    column: str = "name",
) -> DataFrame:
    """The rows that :func:`fuzzy` finds, by way of a name index: names are compared for candidates only.

    A name that contains ``q`` holds all its grams; a name within d edits of it shares all
    but GRAM * d of the longer one's.  Candidates are names with that many common grams and,
    where that bound says nothing, names that are as short as it takes.
    """
    wanted = entities.sparkSession.range(1).select(_grams(F.lit(q)).alias("grams"), F.char_length(F.lower(F.lit(q))).alias("n")).first()
    grams, n = wanted["grams"] or [], wanted["n"]
    if not grams:  # shorter than a gram: every name may hold it
        return entities.where(fuzzy(F.col(column), q, max_distance))
    shared = index.where(F.col("gram").isin(grams)).groupBy("key").agg(F.count("*").alias("common"), F.max("size").alias("size"))
    enough = F.col("common") >= len(grams)
    short = F.lit(False)
    if max_distance is not None:
        lost = GRAM - 1 + GRAM * max_distance
        close = F.abs(F.col("size") - n) <= max_distance
        enough = enough | (close & (F.col("common") >= F.greatest("size", F.lit(n)) - lost))
        if n <= lost:
            short = F.char_length(F.lower(column)) <= lost
    candidates = shared.where(enough).select(F.col("key").alias("__key"))
    found = entities.join(candidates, entities[key] == F.col("__key"), "left_semi").where(fuzzy(F.col(column), q, max_distance))
    if max_distance is None or n > lost:
        return found
    few = entities.where(short).join(candidates, entities[key] == F.col("__key"), "left_anti")
    return found.unionByName(few.where(fuzzy(F.col(column), q, max_distance)))


def search_jobs(
    jobs: DataFrame,
    *,
    statuses: Sequence[str] | None = None,
    created_from: str | None = None,
    created_to: str | None = None,
) -> DataFrame:
    """Jobs by status list and inclusive creation range; page them newest id first."""
    if statuses:
        jobs = jobs.where(F.col("status").isin(*statuses))
    if created_from is not None:
        jobs = jobs.where(F.col("created_at") >= F.lit(created_from).cast("timestamp"))
    if created_to is not None:
        jobs = jobs.where(F.col("created_at") <= F.lit(created_to).cast("timestamp"))
    return jobs


def search_folders(folders: DataFrame, *, parent_id: int | None = None) -> DataFrame:
    """Children of a folder; the root folders when no parent is given."""
    parent = F.col("parent_id")
    return folders.where(parent.isNull() if parent_id is None else parent == parent_id)


def search_projects(
    projects: DataFrame, q: str | None = None, *, max_distance: int | None = None, index: DataFrame | None = None
) -> DataFrame:
    """Projects by fuzzy name; with a stored :func:`name_index` only candidates are compared."""
    if q is None:
        return projects
    if index is not None:
        return fuzzy_search(projects, index, q, max_distance)
    return projects.where(fuzzy(F.col("name"), q, max_distance))


def search_prompts(
    prompts: DataFrame,
    q: str | None = None,
    *,
    document_class: str | None = None,
    include_deleted: bool = False,
    max_distance: int | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Prompts by fuzzy name (see :func:`search_projects`) and class; deleted ones only on request.  Page by name."""
    if not include_deleted:
        prompts = prompts.where(~F.coalesce(F.col("deleted"), F.lit(False)))
    if q is not None and index is not None:
        prompts = fuzzy_search(prompts, index, q, max_distance)
    elif q is not None:
        prompts = prompts.where(fuzzy(F.col("name"), q, max_distance))
    if document_class is not None:
        prompts = prompts.where(F.col("document_class") == document_class)
    return prompts
