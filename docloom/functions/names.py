"""Path, glob and content-type expressions."""

from __future__ import annotations

import mimetypes
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_CONTENT_TYPE = "application/octet-stream"


def path_parts(path: Column) -> Column:
    """Components of a ``/`` path without empty ones and without ``.``."""
    return F.filter(F.split(path, "/", -1), lambda part: (part != "") & (part != "."))


def final_component(path: Column) -> Column:
    """Last component of a path; null where there is none (``""``, ``.``, ``/``, ``..``)."""
    last = F.try_element_at(path_parts(path), F.lit(-1))
    return F.when(last != "..", last)


def folder_segments(path: Column) -> Column:
    """Folder names along a path, base first; empty segments do not count."""
    return F.filter(F.split(path, "/", -1), lambda part: part != "")


def is_blank_folder_path(path: Column) -> Column:
    """True for null, and for paths made only of slashes and spaces."""
    return F.coalesce(F.regexp_replace(path, "^[/ ]+", "") == "", F.lit(True))


def component_order(path: Column) -> Column:
    """Sort key that orders paths component by component, like path objects do."""
    return F.split(path, "/", -1)


def glob_regex(pattern: str) -> str:
    """Anchored regular expression for a relative-path glob.

    ``**`` spans directories, ``*`` and ``?`` stay inside one component, and
    ``[...]`` is a character class.
    """
    parts = [part for part in pattern.split("/") if part not in ("", ".")]
    if not parts:
        raise ValueError("empty glob pattern")
    out: list[str] = []
    for index, part in enumerate(parts):
        last = index == len(parts) - 1
        if part == "**":
            out.append("(?:[^/]+/)*[^/]+" if last else "(?:[^/]+/)*")
            continue
        out.append(_component_regex(part) + ("" if last else "/"))
    return "^" + "".join(out) + "$"


def _component_regex(part: str) -> str:
    tokens = re.findall(r"\[!?\]?[^\]]*\]|\*+|\?|[^*?\[]+|\[", part)
    rendered = []
    for token in tokens:
        if token.startswith("*"):
            rendered.append("[^/]*")
        elif token == "?":
            rendered.append("[^/]")
        elif len(token) > 2 and token[0] == "[" and token[-1] == "]":
            body = token[1:-1].replace("\\", "\\\\")
            rendered.append("[^" + body[1:] + "]" if body[0] == "!" else "[" + body + "]")
        else:
            rendered.append(re.sub(r"([.^$+{}()|\[\]\\])", r"\\\1", token))
    return "".join(rendered)


def _lookup(key: Column, table: dict[str, str]) -> Column:
    entries = [F.lit(item) for pair in sorted(table.items()) for item in pair]
    return F.try_element_at(F.create_map(*entries), key)


def guess_content_type(name: Column, override: str | None = None) -> Column:
    """Content type from a file name; unknown names are octet streams.

    The table is Python's built-in one, without the machine's own additions, so
    every node answers alike.  Compression suffixes are looked through
    (``a.tar.gz`` is a tar file).
    """
    if override is not None:
        return F.lit(override)
    table = mimetypes.MimeTypes(filenames=())
    base = F.element_at(F.split(name, "/", -1), -1)
    suffix = r"(?s)^\.*[^.].*?(\.[^.]*)$"
    ext = F.regexp_extract(base, suffix, 1)
    combined = _lookup(F.lower(ext), table.suffix_map)
    stem = F.regexp_replace(base, r"\.[^.]*$", "")
    full = F.when(combined.isNotNull(), F.concat(stem, combined)).otherwise(base)
    outer = F.regexp_extract(full, suffix, 1)
    packed = _lookup(outer, table.encodings_map).isNotNull()
    inner = F.when(packed, F.regexp_replace(full, r"\.[^.]*$", "")).otherwise(full)
    final = F.lower(F.regexp_extract(inner, suffix, 1))
    return F.coalesce(_lookup(final, table.types_map[True]), F.lit(DEFAULT_CONTENT_TYPE))
