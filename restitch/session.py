"""Session helpers shared by every operator: table reading, spreading, lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "restitch", cores: str = "*", shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; a parquet file or a folder of them."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str, per_core: int = 3) -> DataFrame:
    """Split ``df`` over all cores when its scan has fewer tasks than cores.

    Python stages are CPU-bound, so a scan of two large files must not run in two
    tasks.  Inputs that already have enough splits, as any large input has, are left
    as they are: no shuffle then.  The keys make the split repeatable after a loss.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(per_core * cores, *keys)


_written: list[str] = []


def written(df: DataFrame) -> DataFrame:
    """Cut lineage by a table in the shared folder that ``spark.checkpoint.dir`` names.

    A compressed table is a fraction of an uncompressed checkpoint, survives the loss of any
    executor, and is read column by column.  The tables are removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/restitch-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _written:
        atexit.register(_remove_written)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove_written() -> None:
    spark = SparkSession.getActiveSession()
    for path in _written:
        try:
            if path.startswith(("file:", "/")):
                shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)
            elif spark is not None:
                jvm = spark.sparkContext._jvm
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session is ending anyway
            pass


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only in a local session that names none (tests)."""
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared
    if not sc.master.startswith("local"):
        raise RuntimeError("a cluster must name its shared folder in spark.checkpoint.dir")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="restitch-ckpt-"))
    return os.path.dirname(sc._jsc.sc().getCheckpointDir().get())
