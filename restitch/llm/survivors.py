"""Problem 1: the best representative of each group of duplicate capture records.

Records of one page version are the same page (identity: path and sorted query) with
the same digest; a record without a complete digest goes with the records of the same
page and second.  Every group yields one survivor: the record ranked first by
completeness, trust and recency, with the record id as the last tie-break, and beside
it the best value of each field over the whole group.

Plan: rows are first condensed per (page, digest, time, source) with map-side combine,
so a group of copies that holds a third of all rows is a handful of rows before the
first shuffle of it; the condensed rows are written once and read twice.  The ranking
window keeps row_number() = 1, which Spark prunes in the map tasks (WindowGroupLimit),
so no task ever sorts a whole hot group; the best value of each field is an aggregate
with map-side combine.

Defined results: null url has no page and is no case; without digest and without a
valid time a record is a group of its own; null or unknown sources have trust below all
known ones and never become the best source; repeated rows count as records of their
own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restitch.functions.captures import digest32, source_key, time14
from restitch.functions.urls import page_identity
from restitch.session import written

#: Fields whose presence makes a record more complete.
COMPLETE_FIELDS = ("mime", "status", "bytes", "verified", "error", "loaded_at")


def normal_captures(captures: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per record: rec_id, page, ts14, digest, source (as in ``sources``), trust, filled."""
    known = sources.where(F.col("source").isNotNull()).groupBy(source_key(F.col("source")).alias("skey")).agg(
        F.max(F.struct(F.coalesce("trust", F.lit(-1)).alias("trust"), "source")).alias("s")
    )
    present = [F.col(c).isNotNull().cast("int") for c in COMPLETE_FIELDS if c in captures.columns]
    rows = captures.where("url is not null").select(
        "rec_id",
        page_identity(F.col("url")).alias("page"),
        time14(F.col("ts")).alias("ts14"),
        digest32(F.col("digest")).alias("digest"),
        source_key(F.col("source")).alias("skey"),
        sum(present, F.lit(0)).alias("filled"),
    )
    return rows.join(known, "skey", "left").select(
        "rec_id", "page", "ts14", "digest", F.col("s.source").alias("source"),
        F.coalesce(F.col("s.trust"), F.lit(-1)).alias("trust"), "filled",
    )


def condensed(rows: DataFrame) -> DataFrame:
    """Rows of equal page, digest, time and source as one, keeping counts and the record ranked first.

    A record with neither digest nor time stays a row of its own (``lone``).
    """
    lone = F.when(F.col("digest").isNull() & F.col("ts14").isNull(), F.col("rec_id"))
    return rows.groupBy("page", "digest", "ts14", "source", "trust", lone.alias("lone")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("rec_id").alias("first_rec"),
        F.max(F.struct("filled", (-F.col("rec_id")).alias("neg"))).alias("top"),
    ).select(
        "page", "digest", "ts14", "source", "trust", "lone", "n", "first_rec",
        F.col("top.filled").alias("filled"), (-F.col("top.neg")).alias("rec_id"),
    )


def grouped(rows: DataFrame) -> DataFrame:
    """Adds the group key (page, gkey): the digest, or the digest found at the page's second, or that second.

    Where a second of a page has several digests, a record without one goes with the smallest.
    The window's groups are the condensed rows of one page and second; a row without a time
    looks for no twin and is spread by its digest or id.
    """
    second = Window.partitionBy("page", F.coalesce("ts14", "digest", F.col("lone").cast("string")))
    twin = F.when(F.col("ts14").isNotNull(), F.min("digest").over(second))
    gkey = F.coalesce("digest", twin, F.concat(F.lit("@"), "ts14"), F.concat(F.lit("#"), F.col("lone").cast("string")))
    return rows.withColumn("gkey", gkey).drop("lone")


def survivors(captures: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per group: its best record and best field values.

    page, n (records), first_rec, rec_id (best record), ts, digest, source (best value each).
    """
    g = grouped(condensed(normal_captures(captures, sources)))
    g = written(g)  # condensed rows, read twice below

    completeness = (
        F.col("filled") + F.col("digest").isNotNull().cast("int") * 4
        + F.col("ts14").isNotNull().cast("int") * 2 + F.col("source").isNotNull().cast("int") * 2
    )
    rank = Window.partitionBy("page", "gkey").orderBy(
        completeness.desc(), F.col("trust").desc(), F.col("ts14").desc_nulls_last(), F.col("rec_id")
    )
    best = g.withColumn("rn", F.row_number().over(rank)).where("rn = 1").select("page", "gkey", "rec_id")
    values = g.groupBy("page", "gkey").agg(
        F.sum("n").alias("n"),
        F.min("first_rec").alias("first_rec"),
        F.max("ts14").alias("ts"),
        F.max("digest").alias("digest"),
        F.max(F.when(F.col("source").isNotNull(), F.struct("trust", "source"))).alias("s"),
    )
    return best.join(values, ["page", "gkey"]).select(
        "page", "n", "first_rec", "rec_id", "ts", "digest", F.col("s.source").alias("source")
    )


def found(captures: DataFrame, sources: DataFrame) -> DataFrame:
    return survivors(captures, sources).where("n >= 2").select("first_rec", "ts", "digest", "source")
