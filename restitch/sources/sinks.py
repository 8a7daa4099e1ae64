"""Sinks: JSON documents, reports, idempotent blob appends, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_document(df: DataFrame, key: str, limit: int = 100_000) -> DataFrame:
    """One row: a JSON object of the rows by key, in order of the key; more rows than a document should hold are an error.

    The count is taken before anything is collected; larger results are written as JSON lines by ``write_json``.
    """
    rest = [c for c in df.columns if c != key]
    n = df.count()
    if n > limit:
        raise ValueError(f"{n} rows are over the {limit} of one document")
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.struct(*rest).alias("v"))))
    return df.agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def write_json(df: DataFrame, folder: str) -> None:
    """The rows as JSON lines, one file per partition, through the commit protocol."""
    df.write.mode("overwrite").json(folder)


def as_lines(df: DataFrame, template: str, *cols: str) -> DataFrame:
    """(value): fixed-width report lines in order."""
    return df.select(F.format_string(template, *cols).alias("value")).orderBy("value")


def exists(spark, folder: str) -> bool:  # noqa: ANN001
    """Whether a folder exists; any other trouble with the file system is raised, not taken for an answer."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def append_new_blobs(blobs: DataFrame, folder: str) -> int:
    """Append blobs (digest, content) whose digest the folder does not hold yet and return how many; running it again adds none."""
    from pyspark.sql import Observation

    fresh = blobs.dropDuplicates(["digest"])
    if exists(blobs.sparkSession, folder):
        fresh = fresh.join(blobs.sparkSession.read.parquet(folder).select("digest"), "digest", "left_anti")
    seen = Observation()
    fresh.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(folder)
    return seen.get["n"]


def replace_table(df: DataFrame, folder: str, *partition_by: str) -> None:
    """Overwrite a table through the commit protocol of the file system."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)


def fenced(text, mark: str, block):  # noqa: ANN001, ANN201 - columns
    """A page with a fenced block after its head tag; an older block of the same mark is replaced, so running it again changes nothing."""
    start, end = f"<!-- {mark} -->", f"<!-- /{mark} -->"
    bare = F.regexp_replace(text, f"(?s){start}.*?{end}\n?", "")
    return F.regexp_replace(bare, r"(?i)(<head\b[^>]*>)", F.concat(F.lit("$1" + start), block, F.lit(end + "\n")))
