"""Session construction and cluster-shared locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (timestamps are stored as
# timestamp_ntz and compared with engines that are UTC-naive), ANSI casts
# (a bad cast fails the job, as the source database would), and adaptive
# execution for runtime coalescing, skew splitting and broadcast conversion.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "changeloom", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None,
              driver_memory: str | None = None) -> SparkSession:
    """Return the active session, creating one with the defaults above.

    ``master`` is only for local runs and tests; on a cluster leave it unset
    so the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage; without it the
    call fails, because a folder of one machine is invisible to the others.
    Only a local master (tests, single machine) gets a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver "
                               f"and all executors share (master is {master!r})")
        current = tempfile.mkdtemp(prefix="changeloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table: one folder per application below
    the shared checkpoint folder, so it can be removed when the run is over."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark).rstrip('/')}/{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read
    it back: cuts the lineage, survives lost executors, prunes on re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path (any file system Spark can reach)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing lazy depends on any more."""
    for t in tables:
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            remove_path(t.sparkSession, folder)
