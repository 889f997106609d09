"""One key with a third of all rows: results stay whole, linear and splittable."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docloom.operators import extraction as ex
from docloom.operators import ingest as i
from docloom.operators import replay
from docloom.operators.downloads import plan_downloads
from docloom.operators.folders import resolve_folder_paths
from docloom.operators.selectors import Catalog, combine, select_documents, tagged

ROWS = 30_000


@pytest.fixture()
def skewed(spark):
    """Settings under which even small partitions count as skewed, and no broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    numbers = spark.range(0, ROWS, 1, 12)
    yield numbers.withColumn("k", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")))
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(frame) -> tuple[int, str]:
    rows = len(frame.collect())
    return rows, frame._jdf.queryExecution().executedPlan().toString()


def test_replay_splits_the_hot_key(skewed):
    requests = skewed.select(
        F.col("k").alias("key"), F.lit("h").alias("payload_hash"), F.col("id").alias("ts"), F.col("id").alias("request_id")
    )
    rows, plan = final_plan(replay.replay_requests(requests))
    assert rows == ROWS and "skew=true" in plan
    outcome = dict(replay.replay_requests(requests).groupBy("outcome").count().collect())
    assert outcome == {"executed": ROWS - ROWS // 3 + 1, "replayed": ROWS // 3 - 1}


def test_flatten_splits_a_hot_document(skewed):
    results = skewed.select(
        F.col("k").alias("document_id"), F.col("id").alias("prompt_id"), F.lit(None).cast("string").alias("name"),
        F.col("id").cast("string").alias("value_text"), F.lit(None).cast("decimal(38,23)").alias("value_number"),
        F.lit(None).cast("boolean").alias("value_bool"), F.lit(None).cast("date").alias("value_date"),
        F.col("id").cast("string").alias("raw_value"),
    )
    documents = skewed.select(F.col("k").alias("id")).distinct().union(skewed.sparkSession.range(10**6, 10**6 + 5))
    rows, plan = final_plan(ex.flatten_values(results, documents=documents))
    assert rows == ROWS + 5 and "skew=true" in plan


def test_equal_contents_stay_linear(skewed):
    content = F.when(F.col("k") == -1, "hot").otherwise(F.col("k").cast("string"))
    incoming = skewed.select(F.col("id").alias("path"), content.alias("md5"))
    catalog = skewed.select("id", F.col("id").cast("string").alias("name"), content.alias("md5"))
    found = i.match_duplicates(incoming, catalog)
    for frame in (found.files, found.members):
        rows, plan = final_plan(frame)
        assert rows == ROWS and "skew=true" in plan
    assert found.files.count() == ROWS and found.members.count() == ROWS
    assert found.files.where(F.col("duplicate_count") == ROWS // 3).count() == ROWS // 3


def test_hot_tagged_document(skewed):
    documents = skewed.select(F.col("k").alias("id")).distinct()
    tags = skewed.select(F.col("k").alias("document_id"), F.lit(1).alias("tag_id"), F.current_timestamp().alias("tagged_at"))
    catalog = Catalog(documents, document_tags=tags)
    assert select_documents(catalog, combine([tagged([1])])).count() == ROWS - ROWS // 3 + 1
    assert select_documents(catalog, combine(exclude=[tagged([1])])).count() == 0


def test_batches_are_numbered_without_one_task(skewed):
    planned = i.plan_batches(skewed.select(F.col("id").alias("path")), "b", order_by=["path"])
    assert planned.where(F.col("ordinal") != F.col("path")).isEmpty()
    assert planned.rdd.getNumPartitions() > 1


def test_hot_names_and_paths(skewed, spark):
    documents = skewed.select("id", F.concat(F.lit("f"), "k").alias("name"))
    rows, plan = final_plan(plan_downloads(documents))
    assert rows == ROWS and "skew=true" in plan
    paths = skewed.select("id", F.concat(F.lit("a/b"), F.col("k") % 50).alias("path"))
    folders = spark.createDataFrame([], "id long, name string, parent_id long")
    out = resolve_folder_paths(folders, paths)
    assert out.created.count() <= 51 + 1 and out.resolved.count() == ROWS


def test_small_reduced_side_is_broadcast_by_measured_size(skewed, spark):
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    requests = skewed.select(
        (F.col("id") % 7).alias("key"), F.lit("h").alias("payload_hash"), F.col("id").alias("ts"), F.col("id").alias("request_id")
    )
    rows, plan = final_plan(replay.replay_requests(requests))
    assert rows == ROWS and "BroadcastHashJoin" in plan
