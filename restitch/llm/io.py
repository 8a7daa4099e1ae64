"""Rows, layouts and joins shared by the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces into which a hot key is split by salted_join.
PIECES = 16


def field_rows(table: DataFrame, tbl: str, key: str, fields: list[str]) -> DataFrame:
    """(tbl, rec_id, field, text) with one row per non-empty field; other columns play no part."""
    cols = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    return (
        table.select(F.lit(tbl).alias("tbl"), F.col(key).alias("rec_id"), F.explode(cols).alias("f"))
        .select("tbl", "rec_id", "f.field", "f.text")
        .where("text is not null and text != ''")
    )


def fanned(df: DataFrame, *keys: str, per_core: int = 3) -> DataFrame:
    """Spread reduced rows over all cores before a CPU-bound Python stage.

    A number of partitions that is asked for is kept as it is at run time, while a shuffle of few
    bytes would be merged into few tasks.  It grows with the session's shuffle partitions.
    """
    spark = df.sparkSession
    n = max(per_core * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys)


def salted_join(many: DataFrame, one: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Inner join of rows with a table that has one row per key, a hot key being split into PIECES by a hash of ``by``."""
    left = many.withColumn("_piece", F.pmod(F.xxhash64(by), F.lit(PIECES)).cast("int"))
    right = one.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    return left.join(right, [*keys, "_piece"]).drop("_piece")
