"""Writers and readers of the layered folders (raw / marts / snapshots /
tests), one folder per relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.schemas import RAW_COLUMNS


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Staging relations are views: lazily re-evaluated on every use."""
    df.createOrReplaceTempView(name)
    return df


def publish_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Marts and snapshots are full-refresh tables."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_raw(raw: DataFrame, path: str) -> None:
    """Land a static change log, partitioned by source table (each staging
    model then reads one partition) and ordered by entity time.

    Range-partitioned on time and position, so that many events of one time
    (a table's snapshot has a single one) are still spread over tasks."""
    order = ["source_table", "ts_ms", "topic", "partition", "offset_value"]
    (raw.select(*RAW_COLUMNS)
     .repartitionByRange(*order)
     .sortWithinPartitions(*order)
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("source_table").parquet(path))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*RAW_COLUMNS)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, base: str) -> list[int]:
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        done = fs.exists(st.getPath().suffix("/_SUCCESS"))
        if name.startswith("v=") and name[2:].isdigit() and done:
            out.append(int(name[2:]))
    return sorted(out)


def publish_versioned(df: DataFrame, base: str) -> str:
    """Write ``df`` as the next version ``<base>/v=<n>`` and return its path.

    A table that is rebuilt from itself (SCD2 history + new events) cannot
    overwrite the files it reads; each run writes a new version and readers
    switch to it once it is complete (``_SUCCESS`` present).  Works on any
    Hadoop-compatible file system.
    """
    versions = _versions(df.sparkSession, base)
    n = (versions[-1] + 1) if versions else 1
    path = f"{base.rstrip('/')}/v={n}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_versioned(spark: SparkSession, base: str) -> DataFrame | None:
    """The latest complete version under ``base`` (None when there is none)."""
    versions = _versions(spark, base)
    if not versions:
        return None
    return spark.read.parquet(f"{base.rstrip('/')}/v={versions[-1]}")
