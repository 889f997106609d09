from __future__ import annotations

import hashlib
import json

import pyarrow as pa
import pytest
from conftest import tuples
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.enums import DOCUMENT_STATUSES, is_ready, is_terminal, normalize_enum
from docloom.operators import search as q
from docloom.schemas import DOCUMENTS, FOLDERS, JOBS
from docloom.sources import files, pages


@pytest.fixture()
def tree(tmp_path):
    for rel in ("a.pdf", "sub/b.pdf", ".DS_Store", "_under.txt", ".hid/c.txt", ".hid/.no", "sub/_x/_y/z.txt", "a-b/d.txt", "a/e.txt"):
        (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / rel).write_bytes(rel.encode())
    return tmp_path


def test_manifest_lists_what_a_directory_upload_would(spark, tree):
    got = files.file_manifest(spark, str(tree))
    ordered = [r["rel_path"] for r in got.orderBy(*files.manifest_order()).collect()]
    want = sorted(p for p in tree.glob("**/*") if p.is_file() and not p.name.startswith("."))
    assert ordered == [p.relative_to(tree).as_posix() for p in want]
    for row in got.collect():
        assert row["size"] == len(row["rel_path"])
        assert row["md5"] == hashlib.md5(row["rel_path"].encode()).hexdigest()


def test_manifest_pattern_and_empty(spark, tree):
    got = files.file_manifest(spark, str(tree), pattern="sub/*.pdf", with_md5=False)
    assert tuples(got, "rel_path") == [("sub/b.pdf",)] and "md5" not in got.columns
    with pytest.raises(ValueError, match="no files"):
        files.require_files(files.file_manifest(spark, str(tree), pattern="*.zip"), "*.zip")


def test_manifest_of_deep_trees_odd_names_and_long_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "CHUNK_BYTES", 7)
    monkeypatch.setattr(files, "TASK_BYTES", 64)
    monkeypatch.setattr(files, "TASK_DIRECTORIES", 2)
    names = ["/".join(["d"] * 80) + "/end.txt", "a b/c%20d #1?.txt", "é/漢字.pdf", "x/empty", "_h/.i/_j/k.txt", "many/" + "n" * 200]
    names += [f"many/{i}.bin" for i in range(40)]
    for n, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name.endswith("empty") else bytes(range(256)) * n)
    (tmp_path / "no files here").mkdir()
    got = files.file_manifest(spark, str(tmp_path) + "/").collect()
    assert {r["rel_path"]: (r["size"], r["md5"]) for r in got} == {
        n: ((tmp_path / n).stat().st_size, hashlib.md5((tmp_path / n).read_bytes()).hexdigest()) for n in names
    }
    shown = files.file_manifest(spark, str(tmp_path), with_md5=False, include_hidden=False)
    assert {r["rel_path"] for r in shown.collect()} == {n for n in names if not n.startswith("_")}
    with pytest.raises(Exception, match="nowhere"):
        files.file_manifest(spark, str(tmp_path / "nowhere")).collect()


def test_listing_and_hashing_run_in_tasks(spark, tree):
    """Nothing but numbers comes to the driver, and contents are read for matching files only."""
    (tree / "sub" / "unreadable").write_bytes(b"x")
    (tree / "sub" / "unreadable").chmod(0)
    assert tuples(files.file_manifest(spark, str(tree), pattern="sub/*.pdf"), "rel_path") == [("sub/b.pdf",)]
    plan = files.file_manifest(spark, str(tree))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "LocalTableScan" not in plan and "binaryFile" not in plan.lower()


def test_listed_files(spark, tree):
    paths = [str(tree / "sub/b.pdf"), str(tree / "_under.txt")]
    got = files.listed_files(spark, paths)
    assert tuples(got, "given", "position") == sorted([(p, n) for n, p in enumerate(paths)], key=repr)
    with pytest.raises(ValueError):
        files.listed_files(spark, [])
    with pytest.raises(Exception, match="nope"):
        files.listed_files(spark, [str(tree / "nope")]).collect()


def dump(tmp_path, *page_list):
    path = tmp_path / "dump.json"
    path.write_text("\n".join(json.dumps(p) for p in page_list))
    return str(path)


def page(number, more, *items):
    return {"items": list(items), "page": number, "page_size": 2, "has_more": more}


def test_pages_end_at_the_first_last_page(spark, tmp_path):
    read = pages.read_pages(spark, dump(tmp_path, page(2, False, {"id": 3}), page(1, True, {"id": 1}, {"id": 2}), page(3, False, {"id": 9})))
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert tuples(pages.typed_items(pages.page_items(read), schema), "id") == [(1,), (2,), (3,)]
    assert pages.page_completeness(read).first()["is_complete"] is False


@pytest.mark.parametrize(("numbers", "complete"), [([1, 2, 3], True), ([1, 3], False), ([2, 3], False), ([1, 2, 2], False)])
def test_completeness(spark, tmp_path, numbers, complete):
    last = max(numbers)
    read = pages.read_pages(spark, dump(tmp_path, *[page(n, n < last, {"id": n}) for n in numbers]))
    assert pages.page_completeness(read).first()["is_complete"] is complete


def test_unfinished_dump_keeps_all_items(spark, tmp_path):
    read = pages.read_pages(spark, dump(tmp_path, page(1, True, {"id": 1}), page(2, True, {"id": 2})))
    assert pages.page_items(read).count() == 2
    assert pages.page_completeness(read).first()["is_complete"] is False


def test_open_tail_and_aliases(spark, tmp_path):
    items = [
        {"id": 1, "status": "queued", "createdAt": "2026-05-29T00:00:00Z", "brand_new": {"x": [1, None]}, "other": None},
        {"id": 2, "status": "running", "created_at": "2026-05-29T00:00:01Z", "total_docs": 3},
        {"id": "3", "status": "failed"},
    ]
    rows = pages.typed_items(pages.page_items(pages.read_pages(spark, dump(tmp_path, page(1, False, *items)))), JOBS)
    got = {r["id"]: r for r in rows.withColumn("kept", F.to_json("_extra")).withColumn("s", F.unix_seconds("created_at")).collect()}
    assert json.loads(got[1]["kept"]) == {"brand_new": {"x": [1, None]}, "other": None}
    assert got[2]["s"] == got[1]["s"] + 1 and got[2]["total_docs"] == 3
    assert json.loads(got[2]["kept"]) == {} and got[3]["created_at"] is None


def test_entity_schemas_read(spark, tmp_path):
    doc = {"id": 1, "name": "x", "is_valid": True, "file_size": None, "folder_id": 4, "document_class": "c"}
    read = pages.page_items(pages.read_pages(spark, dump(tmp_path, page(1, False, doc))))
    row = pages.typed_items(read, DOCUMENTS).first()
    assert (row["id"], row["is_valid"], row["file_size"], row["folder_id"]) == (1, True, None, 4)
    assert pages.typed_items(read, FOLDERS).first()["parent_id"] is None


def test_open_enum(table):
    rows = normalize_enum(table("status string", ("ready",), ("quarantined",), (None,)), "status", DOCUMENT_STATUSES)
    got = tuples(rows.withColumn("r", is_ready(F.col("status"))).withColumn("t", is_terminal(F.col("status"))))
    assert got == sorted([("ready", True, True, False), ("quarantined", False, False, False), (None, None, False, False)], key=repr)
    with pytest.raises(TypeError, match="string"):
        normalize_enum(table("status int", (1,)), "status", DOCUMENT_STATUSES)


@pytest.fixture()
def numbers(table):
    return table("id long, v long", *[(n, None if n % 5 == 0 else n % 3) for n in range(1, 24)])


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("deep", [10**6, 0])
def test_pages_tile_the_order(numbers, direction, deep, monkeypatch):
    for name, value in (("DIRECT_ROWS", deep), ("MOST_SORTED", 4), ("RANGES", 4), ("SAMPLED", 2)):
        monkeypatch.setattr(q, name, value)
    everything = [r["id"] for r in q.iterate(numbers, order_by="v", order_dir=direction).collect()]
    key = {r["id"]: r["v"] for r in numbers.collect()}
    sign = 1 if direction == "asc" else -1
    assert everything == sorted(key, key=lambda i: (key[i] is None, sign * (key[i] or 0), i))
    seen, number = [], 1
    while True:
        rows = q.search_page(numbers, page=number, page_size=10, order_by="v", order_dir=direction)
        rows = q.iterate(rows, order_by="v", order_dir=direction).collect()
        seen += [r["id"] for r in rows]
        if not rows[0]["has_more"]:
            break
        number += 1
    assert seen == everything and number == 3


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("column", ["v", "id"])
def test_keyset_walk(numbers, direction, column):
    everything = [r["id"] for r in q.iterate(numbers, order_by=column, order_dir=direction).collect()]
    seen, after = [], None
    while True:
        rows = q.search_after(numbers, after, page_size=7, order_by=column, order_dir=direction).collect()
        if not rows:
            break
        seen += [r["id"] for r in rows]
        after = (rows[-1][column], rows[-1]["id"])
    assert seen == everything


def test_pages_are_not_sorted_as_a_whole(numbers, monkeypatch):
    plan = q.search_page(numbers, page=2, page_size=5, order_by="v")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan.split("TakeOrderedAndProject")[1]
    many = numbers.sparkSession.range(0, 50_000).selectExpr("id", "if(id % 3 = 0, 7, id % 5) as v")
    for name, value in (("DIRECT_ROWS", 100), ("MOST_SORTED", 2_000)):
        monkeypatch.setattr(q, name, value)
    ordered = [r["id"] for r in many.orderBy("v", "id").collect()]
    for page in (2, 61, 400, 500):
        rows = q.search_page(many, page=page, page_size=100, order_by="v").collect()
        assert [r["id"] for r in rows] == ordered[100 * (page - 1) : 100 * page]
        assert {r["has_more"] for r in rows} == {page < 500}
    part, skipped = q._around(many, 39_900, 40_000, "v", "asc", "id")
    assert 0 < 39_900 - skipped and part.count() <= 2_000


def test_page_past_the_end_and_bad_arguments(numbers, monkeypatch):
    assert q.search_page(numbers, page=9, page_size=10).count() == 0
    monkeypatch.setattr(q, "DIRECT_ROWS", 1)
    monkeypatch.setattr(q, "MOST_SORTED", 2)
    assert q.search_page(numbers, page=9, page_size=10).count() == 0
    assert q.search_page(numbers.where("false"), page=9, page_size=10).count() == 0
    with pytest.raises(ValueError):
        q.search_page(numbers, page=0)
    with pytest.raises(ValueError, match="order_dir"):
        q.iterate(numbers, order_dir="up")


def test_lookup_and_searches(numbers, table):
    found, missing = q.lookup(numbers, table("x long", (1,), (2,), (2,), (99,)))
    assert tuples(found, "id") == [(1,), (2,)] and tuples(missing) == [(99,)]
    prompts = table("id long, name string, document_class string, deleted boolean",
                    (1, "Total", "invoice", False), (2, "Subtotal", "receipt", None), (3, "Total old", "invoice", True))
    assert tuples(q.search_prompts(prompts, "total"), "id") == [(1,), (2,)]
    assert tuples(q.search_prompts(prompts, "TOTAL", document_class="invoice", include_deleted=True), "id") == [(1,), (3,)]
    assert tuples(q.search_prompts(prompts, "Totla", max_distance=2), "id") == [(1,)]
    folders = table("id long, parent_id long", (1, None), (2, 1))
    assert tuples(q.search_folders(folders), "id") == [(1,)]
    assert tuples(q.search_folders(folders, parent_id=1), "id") == [(2,)]


@pytest.mark.parametrize("wanted", ["Anna", "annna", "a", "", "aaaa", "Ünï", "bananas split", "xyz"])
@pytest.mark.parametrize("distance", [None, 0, 1, 3])
def test_fuzzy_search_by_index_finds_the_same(table, wanted, distance):
    names = ["Anna", "hannah", "ANN", "an", "", None, "a", "aaaa", "aaa", "ÜNÏcode", "ünï", "banana split", "bananassplit", "xy", "zyx", "Ann a"]
    rows = table("id long, name string, size int, gram string", *[(i, n, 1, "g") for i, n in enumerate(names)], (3, "an", 1, "g"))
    index = q.name_index(rows)
    plain = rows.where(q.fuzzy(F.col("name"), wanted, distance))
    assert tuples(q.fuzzy_search(rows, index, wanted, distance), "id", "name") == tuples(plain, "id", "name")


def test_one_file_per_key_is_written_from_parts_of_many_tasks(spark, tmp_path, monkeypatch):
    listed = []
    tree = files.listed_tree
    monkeypatch.setattr(files, "listed_tree", lambda *a: listed.append(tree(*a)) or listed[-1])
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = [((i * 7919) % 4000, None if i % 900 == 5 else f"text {i} é\U0001f642", None if i < 40 else "a b" if i % 4 else "c") for i in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        written = files.write_text_per_key(docs, "lang", "doc_id", str(tmp_path / "in"), "all.txt").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = {p.parent.name: p.read_bytes() for p in (tmp_path / "in").glob("*/*") if not p.name.startswith(".")}
    wanted = {}
    for _, text, lang in sorted(rows, key=lambda r: r[0]):
        folder = "lang=" + (lang or "__HIVE_DEFAULT_PARTITION__")
        wanted[folder] = wanted.get(folder, b"") + ((text or "") + "\n").encode()
    assert found == wanted
    assert {(r["path"].rsplit("/", 2)[1], r["size"]) for r in written} == {(k, len(v)) for k, v in wanted.items()}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept
    sizes = [r["size"] for r in listed[0].collect() if "/lang=a b/part-" in r["path"]]
    assert max(sizes) < len(wanted["lang=a b"]) / 2 and sum(sizes) == len(wanted["lang=a b"])


def test_a_repeated_task_keeps_a_joined_file(tmp_path):
    (tmp_path / "p0").write_bytes(b"one\n")
    (tmp_path / "p1").write_bytes(b"two\n")
    batch = pa.RecordBatch.from_pydict({"target": [f"file:{tmp_path}/k=1/all.txt"], "parts": [[f"file:{tmp_path}/p0", f"file:{tmp_path}/p1"]]})
    for _ in range(2):  # the second time the parts are gone
        assert [b.to_pylist()[0]["size"] for b in files._join_files(iter([batch]))] == [8]
    assert (tmp_path / "k=1/all.txt").read_bytes() == b"one\ntwo\n" and not (tmp_path / "p0").exists()
    (tmp_path / "k=1/all.txt").unlink()
    with pytest.raises(FileNotFoundError):
        list(files._join_files(iter([batch])))


def test_one_file_per_key_of_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert files.write_text_per_key(none, "lang", "doc_id", str(tmp_path / "in"), "all.txt").count() == 0
    assert not list((tmp_path / "in").iterdir())
