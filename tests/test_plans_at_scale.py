"""What must not move: texts in ingest and extraction, documents in bulk changes."""

from __future__ import annotations

import re

import pytest
from test_skew import final_plan

from docloom.operators import bulk
from docloom.operators.extraction import ExtractRule, answer_documents
from docloom.operators.selectors import Catalog, combine, of_class, sized_between
from docloom.plans.extract import extract
from docloom.plans.ingest import ingest_files
from queryset import tables

FILES = "path string, size long, md5 string, folder_id long, text string"


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def moved_columns(frame) -> str:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return " ".join(re.findall(r"(?:Exchange|Sort|Write)[^\n]*", plan))


def test_bulk_changes_by_own_columns_need_no_join(table, no_broadcast):
    docs = table("id long, folder_id long, document_class string, file_size long", (1, 1, "a", 5), (2, 1, None, 5), (3, 2, "b", 9))
    catalog = Catalog(docs)
    chosen = combine(include=[of_class(["a"])], exclude=[sized_between(8, 10)])
    moved = bulk.move_documents(catalog, chosen, target_folder_id=7)
    left = bulk.delete_documents(catalog, chosen)
    for frame in (moved.documents, left.documents):
        assert "Join" not in frame._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["id"], r["folder_id"]) for r in moved.documents.collect()) == [(1, 7), (2, 1), (3, 2)]
    assert sorted(r["id"] for r in left.documents.collect()) == [2, 3]


def test_ingest_carries_no_text(table, no_broadcast):
    files = table(FILES, ("in/a.txt", 3, "m1", None, "one"), ("in/b.txt", 3, "m2", None, "two"))
    out = ingest_files(files, table("id long, name string, folder_id long, md5 string"), base_key="k")
    for frame in (out.outcomes, out.documents, out.batches, out.ledger, out.duplicates, out.warnings):
        assert "text" not in frame.columns


def test_extraction_moves_answers_only(table, no_broadcast):
    docs = table("id long, status string, page_count long, text string", (1, "ready", 1, "total=5"), (2, "ready", 1, "total=7"))
    rules = [ExtractRule(1, "Total", "String", "total=([0-9]+)", 1)]
    assert "text" not in moved_columns(answer_documents(docs, rules).groupBy("document_id").count())
    out = extract(Catalog(docs), rules, document_ids=[1, 2])
    assert out.values.count() == 2 and final_plan(out.values)[0] == 2
    jobs = table("id long", (41,))
    assert extract(Catalog(docs), rules, document_ids=[1], jobs=jobs).job.first()["id"] == 42


def test_documents_are_dealt_before_their_items_are_sorted(spark, tmp_path):
    spark.range(95).selectExpr(
        "id % 90 div 7 as l_orderkey", "cast(id % 90 % 7 as int) as l_linenumber", "id + 0.5d as l_extendedprice",
        "'O' as l_linestatus", "'N' as l_returnflag", "timestamp'2024-01-01' as l_shipdate",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    dealt = tables.typed_raw(spark, str(tmp_path), docs_per_task=10)
    assert dealt.rdd.getNumPartitions() == 10
    assert sorted(dealt.collect(), key=repr) == sorted(tables.typed_raw(spark, str(tmp_path)).collect(), key=repr)
