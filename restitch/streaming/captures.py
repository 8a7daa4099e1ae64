"""Structured Streaming: captures and comments as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restitch.functions.captures import digest32, time14
from restitch.functions.urls import page_identity
from restitch.operators.comments import is_hard_spam, is_spam


def capture_stream(spark: SparkSession, folder: str, schema, per_trigger: int = 16) -> DataFrame:  # noqa: ANN001
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def deduplicated(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """Each record once per page, digest and second, as long as its copies are at most ``delay`` apart; the state is bounded by the watermark."""
    s = stream.where("url is not null and loaded_at is not null").select(
        "rec_id", page_identity(F.col("url")).alias("page"), digest32(F.col("digest")).alias("digest"), time14(F.col("ts")).alias("ts"), F.col("loaded_at").cast("timestamp").alias("loaded_at")
    )
    return s.withWatermark("loaded_at", delay).dropDuplicatesWithinWatermark(["page", "digest", "ts"])


def daily_counts(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """Captures per day of arrival and source, late rows up to ``delay`` included."""
    s = stream.where("loaded_at is not null").withColumn("at", F.col("loaded_at").cast("timestamp")).withWatermark("at", delay)
    return s.groupBy(F.window("at", "1 day"), F.lower(F.trim("source")).alias("source")).agg(F.count(F.lit(1)).alias("n"))


def flagged_comments(stream: DataFrame) -> DataFrame:
    """Stateless: each comment with its spam verdicts."""
    return stream.select("comment_id", "article_id", is_spam().alias("spam"), is_hard_spam().alias("hard"))


def upsert_latest(batch: DataFrame, folder: str, staging: str) -> None:
    """foreachBatch body: the latest capture of each page and digest, merged into a table.

    The new state is written beside the old one and then replaces it, so a failed batch leaves the old state.
    """
    spark = batch.sparkSession
    new = batch.select("page", "digest", "ts", "rec_id")
    try:
        new = new.unionByName(spark.read.parquet(folder))
    except Exception:  # noqa: BLE001 - first batch
        pass
    top = new.groupBy("page", "digest").agg(F.max(F.struct("ts", "rec_id")).alias("t")).select("page", "digest", "t.ts", "t.rec_id")
    top.write.mode("overwrite").parquet(staging)
    spark.read.parquet(staging).write.mode("overwrite").parquet(folder)
