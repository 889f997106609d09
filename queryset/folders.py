"""Folder tree (F)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import folders as f
from queryset import tables as t
from queryset.registry import query
from queryset.tables import sql


@query("f1_folder_closure", sql("SELECT ancestor_id, descendant_id, CAST(depth AS INTEGER) AS depth FROM closure"))
def closure(spark: SparkSession, sf: str) -> DataFrame:
    return f.folder_closure(f.folder_paths(t.folders(spark, sf)))


@query(
    "f2_full_paths",
    sql("""SELECT a.id, CAST(CASE WHEN b.id IS NULL THEN 0 WHEN c.id IS NULL THEN 1 ELSE 2 END AS INTEGER) AS depth,
             concat_ws('/', c.name, b.name, a.name) AS full_path
        FROM folders a LEFT JOIN folders b ON a.parent_id = b.id
        LEFT JOIN folders c ON b.parent_id = c.id"""),
)
def full_paths(spark: SparkSession, sf: str) -> DataFrame:
    return f.full_paths(f.folder_paths(t.folders(spark, sf)))


@query(
    "f3_has_children",
    sql("""SELECT id, id IN (SELECT parent_id FROM folders WHERE parent_id IS NOT NULL) AS has_children
        FROM folders"""),
)
def has_children(spark: SparkSession, sf: str) -> DataFrame:
    return f.with_has_children(t.folders(spark, sf)).select("id", "has_children")


#: All prefixes of all paths below the root, one row each, and the ids that new folders get.
_PATHS = """paths AS (SELECT id, path, [x FOR x IN string_split(path, '/') IF trim(x) <> ''] AS parts FROM url_paths),
     needed AS (SELECT DISTINCT parts[1:n] AS prefix FROM (SELECT parts, unnest(range(1, len(parts) + 1)) AS n FROM paths)),
     fresh AS (SELECT prefix, (SELECT max(id) FROM folders) + row_number() OVER (ORDER BY len(prefix), prefix) AS id FROM needed),
     steps AS (SELECT p.id, p.path, len(f.prefix) AS depth, f.id AS folder_id FROM paths p
               JOIN (SELECT id, unnest(range(1, len(parts) + 1)) AS n FROM paths) k ON k.id = p.id
               JOIN fresh f ON f.prefix = p.parts[1:k.n])"""


def _with_paths(body: str) -> str:
    base = sql("SELECT 1 FROM folders JOIN url_paths ON true")
    return base[: base.rindex(" SELECT 1")] + ", " + _PATHS + " " + body


@query(
    "f4_resolve_paths",
    _with_paths("""SELECT id, path, string_agg(CAST(folder_id AS VARCHAR), ',' ORDER BY depth) AS folder_ids
        FROM steps GROUP BY id, path"""),
)
def resolve_paths(spark: SparkSession, sf: str) -> DataFrame:
    out = f.resolve_folder_paths(t.folders(spark, sf), t.url_paths(spark, sf))
    ids = F.array_join(F.col("folder_ids").cast("array<string>"), ",")
    return out.resolved.select("id", "path", ids.alias("folder_ids"))


@query(
    "f4_created_folders",
    _with_paths("""SELECT l.id, l.prefix[-1] AS name, r.id AS parent_id
        FROM fresh l LEFT JOIN fresh r ON r.prefix = l.prefix[1:len(l.prefix) - 1]"""),
)
def created_folders(spark: SparkSession, sf: str) -> DataFrame:
    return f.resolve_folder_paths(t.folders(spark, sf), t.url_paths(spark, sf)).created


@query(
    "f4_resolve_existing_paths",
    sql("""SELECT c.id, r.id || ',' || n.id || ',' || c.id AS folder_ids
        FROM folders c JOIN folders n ON c.parent_id = n.id JOIN folders r ON n.parent_id = r.id"""),
)
def resolve_existing(spark: SparkSession, sf: str) -> DataFrame:
    folders = t.folders(spark, sf)
    paths = f.full_paths(f.folder_paths(folders)).where("depth = 2")
    wanted = paths.select("id", F.concat(F.lit("/"), "full_path").alias("path"))
    out = f.resolve_folder_paths(folders, wanted)
    return out.resolved.select(
        "id", F.array_join(F.col("folder_ids").cast("array<string>"), ",").alias("folder_ids")
    )


@query(
    "f5_leaf_per_path",
    _with_paths("SELECT id, max_by(folder_id, depth) AS leaf_id FROM steps GROUP BY id"),
)
def leaf_per_path(spark: SparkSession, sf: str) -> DataFrame:
    out = f.resolve_folder_paths(t.folders(spark, sf), t.url_paths(spark, sf))
    return f.leaf_folders(out).select("id", "leaf_id")


@query("f5_invalid_paths", "SELECT page_id AS id FROM pages WHERE page_id % 5 = 0")
def invalid_paths(spark: SparkSession, sf: str) -> DataFrame:
    broken = F.when(F.col("id") % 5 == 0, F.lit(" / /")).otherwise(F.col("path"))
    paths = t.url_paths(spark, sf).withColumn("path", broken)
    return f.resolve_folder_paths(t.folders(spark, sf), paths).invalid.select("id")


_MOVE_SELECTED = """selected AS (SELECT * FROM folders WHERE parent_id IN (101, 102, 103) OR id IN (1, 103))"""


@query(
    "f6_move_folders",
    sql("SELECT 1 FROM folders").rsplit(" SELECT 1", 1)[0]
    + ", "
    + _MOVE_SELECTED
    + """, target AS (SELECT n.parent_id AS up FROM folders n WHERE n.id = 103),
      named AS (SELECT id, parent_id, CASE WHEN id > 1000 THEN 'branch ' || (id % 10) ELSE name END AS name FROM folders),
      first AS (SELECT name, min(id) AS first_id FROM named WHERE id IN (SELECT id FROM selected) GROUP BY 1)
      SELECT s.id, CASE WHEN s.id > first_id THEN 'duplicate_in_selection'
                        WHEN s.parent_id = 103 THEN 'already_in_target'
                        WHEN s.id = 103 OR s.id = (SELECT up FROM target) THEN 'invalid_parent'
                        WHEN s.name IN (SELECT name FROM named WHERE parent_id = 103) THEN 'name_conflict'
                        ELSE 'moved' END AS outcome
      FROM named s JOIN first ON first.name = s.name WHERE s.id IN (SELECT id FROM selected)""",
)
def move_folders(spark: SparkSession, sf: str) -> DataFrame:
    # Many branches of the same names, so that siblings of other folders share some of them.
    branch = F.concat(F.lit("branch "), F.col("id") % 10)
    named = F.when(F.col("id") > 1000, branch).otherwise(F.col("name"))
    folders = t.folders(spark, sf).withColumn("name", named)
    chosen = folders.where(F.col("parent_id").isin(101, 102, 103) | F.col("id").isin(1, 103))
    moved = f.move_folders(folders, chosen.select("id"), target_parent_id=103)
    return moved.classified.select("id", "outcome")


@query(
    "f6_move_folders_to_root",
    sql("""SELECT count(*) AS matched, count(*) AS moved, CAST(0 AS BIGINT) AS already_in_target,
             CAST(0 AS BIGINT) AS name_conflict, CAST(0 AS BIGINT) AS duplicate_in_selection,
             CAST(0 AS BIGINT) AS invalid_parent FROM folders WHERE parent_id > 100"""),
)
def move_to_root(spark: SparkSession, sf: str) -> DataFrame:
    folders = t.folders(spark, sf)
    return f.move_folders(folders, folders.where("parent_id > 100").select("id")).summary()


@query(
    "f7_delete_folders",
    sql("""SELECT w.id, CASE WHEN f.id IS NULL THEN 'not_found' ELSE 'deleted' END AS outcome, true AS requested
        FROM (SELECT DISTINCT s_suppkey * 20 AS id FROM supplier) w LEFT JOIN folders f ON f.id = w.id"""),
)
def delete_folders(spark: SparkSession, sf: str) -> DataFrame:
    wanted = t.load(spark, sf, "supplier").select((F.col("s_suppkey") * 20).alias("id"))
    return f.delete_folders(t.folders(spark, sf), wanted).classified


@query(
    "f7_delete_subtrees",
    sql("""SELECT id FROM folders WHERE id NOT IN
        (SELECT descendant_id FROM closure WHERE ancestor_id IN (1, 103, 104, 105))"""),
)
def delete_subtrees(spark: SparkSession, sf: str) -> DataFrame:
    folders = t.folders(spark, sf)
    wanted = folders.where(F.col("id").isin(1, 103, 104, 105)).select("id")
    return f.delete_folders(folders, wanted, subtree=True).folders.select("id")


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers give folder creates and renames; some clash with what is there."""
    c = t.load(spark, sf, "customer")
    action = F.when(F.col("c_custkey") % 2 == 0, "create").otherwise("rename")
    name = F.when(F.col("c_custkey") % 6 == 0, F.col("c_name")).otherwise(
        F.concat(F.lit("new-"), "c_mktsegment", F.lit("-"), F.floor(F.col("c_custkey") / 4))
    )
    return c.select(
        F.col("c_custkey").alias("change_id"),
        action.alias("action"),
        F.when(F.col("c_custkey") % 2 == 1, F.col("c_custkey") + t.CUSTOMER_BASE).alias("id"),
        name.alias("name"),
        (F.col("c_nationkey") + t.NATION_BASE).cast("long").alias("parent_id"),
    )


_CHANGES = f"""changes AS (SELECT c_custkey AS change_id,
      CASE WHEN c_custkey % 2 = 0 THEN 'create' ELSE 'rename' END AS action,
      CASE WHEN c_custkey % 2 = 1 THEN c_custkey + {t.CUSTOMER_BASE} END AS id,
      CASE WHEN c_custkey % 6 = 0 THEN c_name ELSE 'new-' || c_mktsegment || '-' || (c_custkey // 4) END AS name,
      CAST(c_nationkey + {t.NATION_BASE} AS BIGINT) AS parent_id FROM customer),
    judged AS (SELECT *, (parent_id, name) IN (SELECT (parent_id, name) FROM folders)
        OR change_id > min(change_id) OVER (PARTITION BY parent_id, name) AS clash FROM changes)"""


def _with_changes(body: str) -> str:
    base = sql("SELECT 1 FROM folders")
    return base[: base.rindex(" SELECT 1")] + ", " + _CHANGES + " " + body


@query(
    "f8_change_conflicts",
    _with_changes("SELECT change_id, action, name, 'NAME_ALREADY_EXISTS' AS code FROM judged WHERE clash"),
)
def change_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    out = f.apply_folder_changes(t.folders(spark, sf), _changes(spark, sf))
    return out.conflicts.select("change_id", "action", "name", "code")


@query(
    "f8_changed_folders",
    _with_changes("""SELECT f.id, coalesce(j.name, f.name) AS name, f.parent_id FROM folders f
        LEFT JOIN judged j ON j.id = f.id AND j.action = 'rename' AND NOT clash
        UNION ALL SELECT (SELECT max(id) FROM folders) + row_number() OVER (ORDER BY change_id), name, parent_id
        FROM judged WHERE action = 'create' AND NOT clash"""),
)
def changed_folders(spark: SparkSession, sf: str) -> DataFrame:
    out = f.apply_folder_changes(t.folders(spark, sf), _changes(spark, sf))
    return out.folders.select("id", "name", "parent_id")
