"""The folder tree: ancestry, paths, get-or-create by path, moves, deletes.

Ancestry uses pointer doubling: after round k every folder knows 2^k steps
towards its root, so a tree of depth d needs about log2(d) joins, and each
round is written to the shared folder so that lineage stays short.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.names import folder_segments, is_blank_folder_path
from docloom.operators.joins import settled
from docloom.operators.ordinals import with_dense_ordinal
from docloom.session import materialize


def folder_paths(folders: DataFrame) -> DataFrame:
    """``id, path_ids, path_names`` from root to the folder itself (runs jobs).

    A folder whose parent is not in the table starts its own path.  A cycle raises
    ``ValueError``: no path is longer than the number of folders.
    """
    known = folders.select(F.col("id").alias("__known"))
    first = folders.join(known, folders["parent_id"] == known["__known"], "left").select(
        "id",
        F.col("__known").alias("up"),
        F.array("id").alias("path_ids"),
        F.array("name").alias("path_names"),
    )
    is_open = F.col("up").isNotNull()
    latest = materialize(first, "paths")
    done = latest.where(~is_open)
    reach, most = 1, latest.count()
    while not latest.where(is_open).isEmpty():
        if reach > most:
            raise ValueError("the folder tree has a cycle")
        waiting = latest.where(is_open)
        upper = done.unionByName(waiting).select(
            F.col("id").alias("up"),
            F.col("up").alias("next_up"),
            F.col("path_ids").alias("upper_ids"),
            F.col("path_names").alias("upper_names"),
        )
        moved = waiting.join(upper, "up", "left").select(
            "id",
            F.col("next_up").alias("up"),
            F.concat("upper_ids", "path_ids").alias("path_ids"),
            F.concat("upper_names", "path_names").alias("path_names"),
        )
        # Finished folders are not written again.
        latest = materialize(moved, "paths")
        done = done.unionByName(latest.where(~is_open))
        reach *= 2
    return done.select("id", "path_ids", "path_names")


def folder_closure(paths: DataFrame) -> DataFrame:
    """``ancestor_id, descendant_id, depth`` out of :func:`folder_paths`; depth 0 is the folder."""
    steps = paths.select(
        F.col("id").alias("descendant_id"),
        F.size("path_ids").alias("__len"),
        F.posexplode("path_ids").alias("__pos", "ancestor_id"),
    )
    return steps.select(
        "ancestor_id", "descendant_id", (F.col("__len") - 1 - F.col("__pos")).alias("depth")
    )


def full_paths(paths: DataFrame, separator: str = "/") -> DataFrame:
    """``id, depth, full_path`` with the names joined root to leaf."""
    return paths.select(
        "id",
        (F.size("path_ids") - 1).alias("depth"),
        F.array_join("path_names", separator).alias("full_path"),
    )


def subtree_ids(folders: DataFrame, roots: Sequence[int] | DataFrame) -> DataFrame:
    """Ids of the given folders (a list or a one-column table) and of all folders below them (runs jobs).

    Every folder asks whether it or a folder above it is given, by pointer doubling: a
    round looks twice as far up as the one before, so depth d takes about log2(d) narrow
    joins, however many roots there are.  A folder that has found one asks no more.
    No path is longer than the number of folders; what still asks then goes in a circle.
    """
    given = F.col("id").isin(*roots) if not isinstance(roots, DataFrame) else F.col("__given").isNotNull()
    known = folders.select(F.col("id").alias("__known"))
    first = folders.select("id", "parent_id").join(settled(known), F.col("parent_id") == F.col("__known"), "left")
    if isinstance(roots, DataFrame):
        ids = roots.select(F.col(roots.columns[0]).cast("long").alias("__given")).distinct()
        first = first.join(settled(ids), F.col("id") == F.col("__given"), "left")
    latest = materialize(first.select("id", F.col("__known").alias("up"), F.coalesce(given, F.lit(False)).alias("inside")), "subtree")
    asks = F.col("up").isNotNull() & ~F.col("inside")
    done, reach, most = latest.where(~asks), 1, latest.count()
    while reach <= most and not latest.where(asks).isEmpty():
        waiting = latest.where(asks)
        upper = done.unionByName(waiting).select(
            F.col("id").alias("up"), F.col("up").alias("next_up"), F.col("inside").alias("upper_inside")
        )
        moved = waiting.join(settled(upper), "up", "left").select(
            "id", F.col("next_up").alias("up"), F.coalesce("upper_inside", F.lit(False)).alias("inside")
        )
        latest = materialize(moved, "subtree")
        done = done.unionByName(latest.where(~asks))
        reach *= 2
    return done.where("inside and id is not null").select("id").distinct()


def with_has_children(folders: DataFrame) -> DataFrame:
    """Add the derived ``has_children`` flag."""
    parents = folders.where(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("id"), F.lit(True).alias("__parent")
    )
    flagged = folders.join(parents.distinct(), "id", "left")
    has = F.coalesce(F.col("__parent"), F.lit(False))
    return flagged.withColumn("has_children", has).drop("__parent")


@dataclass(frozen=True)
class ResolvedPaths:
    """Outcome of a path resolution.

    ``folders`` is the whole folder table after it, ``created`` its new rows,
    ``resolved`` one row per input path with the ids and names from base to
    leaf, ``invalid`` the inputs without any folder name.
    """

    folders: DataFrame
    created: DataFrame
    resolved: DataFrame
    invalid: DataFrame


def resolve_folder_paths(
    folders: DataFrame,
    paths: DataFrame,
    *,
    path_col: str = "path",
    parent_id: int | None = None,
) -> ResolvedPaths:
    """Get-or-create every ``/`` path of a column below ``parent_id`` (runs jobs).

    Missing folders are created once however many paths need them, with ids that
    continue after the largest one in path order; running it again on the result
    creates nothing.  All input columns stay on ``resolved``, one row per input.
    """
    base_ids, base_names = [], []
    tree = folder_paths(folders)
    if parent_id is not None:
        base = tree.where(F.col("id") == parent_id).first()
        if base is None:
            raise ValueError(f"no folder with id {parent_id}")
        base_ids, base_names = base["path_ids"], base["path_names"]
    prefix = F.array(*[F.lit(n) for n in base_names]).cast("array<string>")

    blank = is_blank_folder_path(F.col(path_col)) | (F.size(folder_segments(F.col(path_col))) == 0)
    invalid = paths.where(blank)
    usable = paths.where(~blank).withColumn(
        "path_names", F.concat(prefix, folder_segments(F.col(path_col)))
    )

    depths = F.sequence(F.lit(len(base_names) + 1), F.size("path_names"))
    needed = (
        usable.select("path_names")
        .distinct()
        .select(F.explode(F.transform(depths, lambda n: F.slice("path_names", 1, n))).alias("path_names"))
        .distinct()
    )
    # Sibling names are unique; should they repeat, the smallest id answers.
    existing = tree.groupBy("path_names").agg(F.min("id").alias("id"))
    missing = needed.join(existing, "path_names", "left_anti")
    next_id = (folders.agg(F.max("id")).first()[0] or 0) + 1
    fresh = with_dense_ordinal(
        missing, [F.size("path_names"), F.col("path_names")], "id", start=next_id
    )
    known = materialize(existing.unionByName(fresh), "known")
    parents = known.select(
        F.col("path_names").alias("parent_names"), F.col("id").alias("parent_id")
    )
    parent_names = F.slice("path_names", 1, F.size("path_names") - 1)
    created = materialize(
        fresh.withColumn("parent_names", parent_names)
        .join(parents, "parent_names", "left")
        .select("id", F.element_at("path_names", -1).alias("name"), "parent_id"),
        "created",
    )
    whole = folders.unionByName(created, allowMissingColumns=True)
    # One row per distinct path and depth, looked up by its prefix.
    steps = usable.select("path_names").distinct().select(
        F.col("path_names").alias("leaf"), F.explode(depths).alias("depth")
    )
    prefixes = steps.withColumn("path_names", F.slice("leaf", F.lit(1), F.col("depth")))
    chains = (
        prefixes.join(known, "path_names", "left")
        .groupBy("leaf")
        .agg(F.array_sort(F.collect_list(F.struct("depth", "id"))).alias("chain"))
        .select(F.col("leaf").alias("path_names"), F.col("chain.id").alias("folder_ids"))
    )
    names = F.slice("path_names", F.lit(len(base_names) + 1), F.size("path_names"))
    resolved = usable.join(settled(chains), "path_names", "left").withColumn("folder_names", names)
    return ResolvedPaths(whole, created, resolved.drop("path_names"), invalid)


def leaf_folders(resolved: ResolvedPaths) -> DataFrame:
    """The last folder of every valid path, as ``leaf_id``."""
    return resolved.resolved.withColumn("leaf_id", F.element_at("folder_ids", -1))


@dataclass(frozen=True)
class FolderMove:
    """``classified`` has one row per selected folder; ``folders`` is the new table."""

    folders: DataFrame
    classified: DataFrame

    def summary(self) -> DataFrame:
        """One row: matched and the size of each class."""
        outcome = F.col("outcome")
        return self.classified.agg(
            F.count("*").alias("matched"),
            *[F.count_if(outcome == name).alias(name) for name in MOVE_OUTCOMES],
        )


MOVE_OUTCOMES = (
    "moved",
    "already_in_target",
    "name_conflict",
    "duplicate_in_selection",
    "invalid_parent",
)


def move_folders(
    folders: DataFrame,
    selected: DataFrame,
    *,
    target_parent_id: int | None = None,
    paths: DataFrame | None = None,
) -> FolderMove:
    """Move folders below ``target_parent_id`` (root when omitted).

    ``selected`` is a one-column table of ids.  The first class that fits wins:
    duplicate in selection (same name as a smaller id in it), already in target,
    invalid parent (the target lies inside the folder), name conflict (a sibling
    in the target has the name), moved.
    """
    ids = selected.select(F.col(selected.columns[0]).cast("long").alias("id")).distinct()
    rows = folders.join(ids, "id", "left_semi").select("id", "name", "parent_id")

    first_of_name = rows.groupBy("name").agg(F.min("id").alias("first_id"))
    in_target = (
        F.col("parent_id").isNull()
        if target_parent_id is None
        else F.col("parent_id") == target_parent_id
    )
    siblings = folders.where(F.coalesce(in_target, F.lit(False))).select("name").distinct()
    siblings = siblings.withColumn("taken", F.lit(True))

    if target_parent_id is None:
        inside = F.lit(False)
    else:
        tree = folder_paths(folders) if paths is None else paths
        target = tree.where(F.col("id") == target_parent_id).first()
        if target is None:
            raise ValueError(f"no folder with id {target_parent_id}")
        # The target's ancestors (itself included) cannot be moved into it.
        inside = F.col("id").isin(*target["path_ids"])
    outcome = (
        F.when(F.col("id") > F.col("first_id"), "duplicate_in_selection")
        .when(F.coalesce(in_target, F.lit(False)), "already_in_target")
        .when(inside, "invalid_parent")
        .when(F.col("taken"), "name_conflict")
        .otherwise("moved")
    )
    classified = (
        rows.join(settled(first_of_name), "name", "left")
        .join(settled(siblings), "name", "left")
        .select("id", "name", outcome.alias("outcome"))
    )
    moved = classified.where(F.col("outcome") == "moved").select("id", F.lit(True).alias("__moved"))
    target_id = F.lit(target_parent_id).cast("long")
    table = folders.join(moved, "id", "left").withColumn(
        "parent_id", F.when(F.col("__moved"), target_id).otherwise(F.col("parent_id"))
    )
    return FolderMove(table.drop("__moved").select(*folders.columns), classified)


@dataclass(frozen=True)
class FolderDelete:
    folders: DataFrame
    classified: DataFrame

    def summary(self) -> DataFrame:
        """One row: requested ids and deleted folders."""
        return self.classified.agg(
            F.count_if("requested").alias("requested"),
            F.count_if(F.col("outcome") == "deleted").alias("deleted"),
        )


def delete_folders(folders: DataFrame, requested: DataFrame, *, subtree: bool = False) -> FolderDelete:
    """Delete folders by id; ids that are not there come back as ``not_found``.

    With ``subtree`` the folders below go too (this runs jobs); they are listed
    as deleted but were not requested.
    """
    ids = requested.select(F.col(requested.columns[0]).cast("long").alias("id")).distinct()
    present = folders.select("id", F.lit(True).alias("__here"))
    found = F.when(F.col("__here"), "deleted").otherwise("not_found")
    classified = ids.join(present, "id", "left").select(
        "id", found.alias("outcome"), F.lit(True).alias("requested")
    )
    if subtree:
        below = (
            subtree_ids(folders, ids)
            .join(ids, "id", "left_anti")
            .select("id", F.lit("deleted").alias("outcome"), F.lit(False).alias("requested"))
        )
        classified = classified.unionByName(below)
    gone = classified.where(F.col("outcome") == "deleted").select("id")
    return FolderDelete(folders.join(gone, "id", "left_anti"), classified)


@dataclass(frozen=True)
class FolderChanges:
    folders: DataFrame
    conflicts: DataFrame


def apply_folder_changes(folders: DataFrame, changes: DataFrame) -> FolderChanges:
    """Apply creates and renames from a change table ``change_id, action, id, name, parent_id``.

    ``action`` is ``create`` or ``rename`` (``id`` names the folder).  A change whose
    name is taken by a sibling in ``folders``, or by an earlier change (smaller
    ``change_id``) for the same place, is a conflict row and is not applied; a
    rename of an unknown folder is one too, a rename to the same name is none.  New ids follow the largest id in
    ``change_id`` order (this runs a job).
    """
    current = folders.select(
        F.col("id").alias("__id"),
        F.col("parent_id").alias("__parent"),
        F.col("name").alias("__name"),
    )
    renames = (
        changes.where(F.col("action") == "rename")
        .join(current, F.col("id") == F.col("__id"), "left")
        .select("change_id", "action", "id", "name", F.col("__parent").alias("parent_id"),
                F.col("__id").isNull().alias("unknown"),
                F.coalesce(F.col("__name") == F.col("name"), F.lit(False)).alias("unchanged"))
    )
    creates = changes.where(F.col("action") == "create").select(
        "change_id", "action", F.lit(None).cast("long").alias("id"), "name", "parent_id",
        F.lit(False).alias("unknown"), F.lit(False).alias("unchanged"),
    )
    planned = creates.unionByName(renames)
    taken = folders.select("parent_id", "name").distinct().withColumn("taken", F.lit(True))
    first = planned.where(~F.col("unknown")).groupBy("parent_id", "name").agg(
        F.min("change_id").alias("first_change")
    )
    judged = planned
    for side, flag in ((taken, "taken"), (first, "first_change")):
        other = side.select(
            F.col("parent_id").alias("__p"), F.col("name").alias("__n"), F.col(flag)
        )
        place = F.col("parent_id").eqNullSafe(F.col("__p")) & (F.col("name") == F.col("__n"))
        judged = judged.join(settled(other), place, "left").drop("__p", "__n")
    occupied = F.coalesce(F.col("taken"), F.lit(False)) | (
        F.col("change_id") > F.col("first_change")
    )
    clash = F.col("unknown") | (~F.col("unchanged") & occupied)
    judged = materialize(judged.withColumn("conflict", clash), "folder-changes")
    good = judged.where(~F.col("conflict"))
    next_id = (folders.agg(F.max("id")).first()[0] or 0) + 1
    new_rows = with_dense_ordinal(
        good.where(F.col("action") == "create").select("change_id", "name", "parent_id"),
        ["change_id"], "id", start=next_id,
    ).select("id", "name", "parent_id")
    new_names = good.where(F.col("action") == "rename").groupBy("id").agg(
        F.max_by("name", "change_id").alias("__new")
    )
    renamed = folders.join(new_names, "id", "left").withColumn(
        "name", F.coalesce("__new", "name")
    )
    table = renamed.select(*folders.columns).unionByName(new_rows, allowMissingColumns=True)
    reason = F.when(F.col("unknown"), "NOT_FOUND").otherwise("NAME_ALREADY_EXISTS")
    conflicts = judged.where("conflict").select(
        "change_id", "action", "id", "name", "parent_id", reason.alias("code")
    )
    return FolderChanges(table, conflicts)
