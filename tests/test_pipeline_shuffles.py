"""What the pipeline moves for the page objects of earlier runs."""

import pytest

from pagewright.functions.hashing import doc_hash
from pagewright.functions.paths import page_id
from pagewright.plans import pipeline as PL
from pagewright.schemas import DOCUMENTS_STATE, PAGES_STATE
from pyspark.sql import functions as F

NOW = "2024-06-01 00:00:00"


@pytest.fixture
def small_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_text_of_earlier_pages_is_not_shuffled_for_those_split_again(spark, tmp_path, small_broadcasts):
    """F2 of round 3: each stage joined the whole payload with the ids of all pages split now."""
    files = spark.range(600).select(F.concat(F.lit("a/f"), "id", F.lit(".pdf")).alias("path"),
                                    F.concat(F.lit("Text "), "id", F.lit(". More.")).alias("content"))
    twice = files.filter("path = 'a/f7.pdf'").select(page_id(doc_hash("content", "path"), F.lit(1)).alias("page_id")).first()[0]
    old = spark.range(3000).select(
        F.when(F.col("id") < 2, F.lit(twice)).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("page_id"),
        F.lit("d").alias("doc_id"), F.lit(1).alias("page_number"), F.lit("old").alias("gcs_pdf_path"), F.lit("old").alias("text"))
    old.unionByName(old.limit(1).withColumn("page_id", F.lit(None).cast("string"))).write.parquet(str(tmp_path / "payload"))
    ctx = PL.RunContext.create(spark, NOW)
    out = PL.run_pipeline(ctx, files, spark.createDataFrame([], DOCUMENTS_STATE), spark.createDataFrame([], PAGES_STATE),
                          payload=spark.read.parquet(str(tmp_path / "payload")))
    plan = out["payload"]._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    rows = out["payload"].groupBy("gcs_pdf_path").count().collect()
    # the two old rows of the page that was split again are replaced, a null id stays
    assert {r[1] for r in rows if r[0] == "old"} == {2999} and len(rows) == 601
    assert [r.text for r in out["payload"].filter(F.col("page_id") == twice).collect()] == ["Text 7. More."]
    assert [r.page_id for r in ctx.tables["payload_replaced"].collect()] == [twice]
    assert ctx.tables["split_queue"].count() == 600 and out["index"].count() == 600
