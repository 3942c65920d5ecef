"""Tables in key-hash buckets that are updated without rewriting them.

A table is a folder of data folders and numbered manifests.  A manifest says
for every bucket in which data folder its rows are; the highest number is the
table.  An update

1. writes its new rows once and takes the buckets they hash to,
2. reads those buckets alone, merges, and writes them to a new data folder,
3. writes the next manifest under a temporary name and renames it.

The rename is the commit: a writer that dies before it leaves the old version
as it was, and of two writers of one number the second fails with
``ConcurrentUpdate`` and can start again.  ``vacuum`` removes what only older
manifests refer to, and what unfinished writers left.

The manifest has one entry a bucket, whatever the number of rows; choose
``buckets`` so that a bucket is some hundred megabytes.  A large bucket is
written by several tasks.  All file access goes through Hadoop file systems.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeloom.operators.latest import latest_by_key
from changeloom.session import remove_path, stage, unstage

BUCKET = "_bucket"


class ConcurrentUpdate(RuntimeError):
    """Another writer has committed the version this one wanted to be."""


class BucketedTable:
    """One table below ``base``; ``create`` makes it, the constructor opens it."""

    def __init__(self, spark: SparkSession, base: str, version: int | None = None):
        self.spark, self.base = spark, base.rstrip("/")
        known = self._versions()
        if not known:
            raise FileNotFoundError(f"no table at {base}")
        self.version = known[-1] if version is None else version
        m = json.loads(self._text(f"{self.base}/manifests/{self.version:012d}.json"))
        self.keys, self.buckets, self.folders = m["keys"], m["buckets"], m["folders"]
        self.schema = StructType.fromJson(m["schema"])
        self.properties: dict = m.get("properties", {})

    # Files

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _versions(self) -> list[int]:
        names = self._names(f"{self.base}/manifests")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _commit(self, version: int, manifest: dict) -> None:
        """Publish a manifest by a rename that fails if the name is taken."""
        jvm = self.spark._jvm
        target = f"{self.base}/manifests/{version:012d}.json"
        fs, temporary = self._fs(f"{self.base}/manifests/.{version:012d}-{uuid.uuid4().hex}")
        stream = fs.create(temporary, False)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            temporary.toUri() if temporary.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration())
        plain = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(temporary, jvm.org.apache.hadoop.fs.Path(target), plain)
        except Exception as error:
            fs.delete(temporary, False)
            if "FileAlreadyExists" in str(error):
                raise ConcurrentUpdate(f"version {version} of {self.base} exists") from error
            raise

    # Reading

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of the table, or of some of its buckets only."""
        wanted = self.folders if buckets is None else {str(b) for b in buckets} & set(self.folders)
        paths = [f"{self.base}/data/{self.folders[b]}/{BUCKET}={b}" for b in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def bucket_of(self, keys: list[str] | None = None) -> Column:
        return _bucket(keys or self.keys, self.buckets)

    # Writing

    @staticmethod
    def create(df: DataFrame, base: str, keys: list[str], buckets: int = 64,
               properties: dict | None = None) -> "BucketedTable":
        """Write ``df`` as the first version.  ``properties`` are kept in the manifest."""
        table = BucketedTable.__new__(BucketedTable)
        table.spark, table.base = df.sparkSession, base.rstrip("/")
        if table._versions():
            raise ConcurrentUpdate(f"there is a table at {base}")
        table.keys, table.buckets, table.schema, table.folders, table.version = keys, buckets, df.schema, {}, 0
        fs, p = table._fs(f"{table.base}/manifests")
        fs.mkdirs(p)
        return table._write(df, None, properties or {})

    def update(self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame],
               properties: dict | None = None, staged: bool = False) -> "BucketedTable":
        """The next version: ``merge(rows, changes)`` replaces the buckets that the
        keys of ``changes`` hash to, where ``rows`` are the rows of those buckets.
        ``merge`` must return the table's columns and keep the keys of other rows.
        ``properties`` are set in the same commit; without them and without
        changes there is no new version.  ``staged`` says that ``changes`` are
        written already (``session.stage``); they are then not written again."""
        written = changes if staged else stage(changes, "bucketed-changes")
        touched = [r[0] for r in written.select(self.bucket_of().alias("b")).distinct().collect()]
        if not touched and properties is None:
            return self
        merged = merge(self.read(touched), written).select(*self.schema.names)
        following = self._write(merged, touched, {**self.properties, **(properties or {})})
        if not staged:
            unstage(written)
        return following

    def _write(self, rows: DataFrame, touched: list[int] | None, properties: dict) -> "BucketedTable":
        version = self.version + 1
        folder = f"{version:012d}-{uuid.uuid4().hex}"
        path = f"{self.base}/data/{folder}"
        # Few files a bucket; a bucket larger than a partition is cut up.
        (rows.withColumn(BUCKET, self.bucket_of()).hint("rebalance", F.col(BUCKET))
         .write.partitionBy(BUCKET).parquet(path))
        filled = {n.split("=")[1] for n in self._names(path) if n.startswith(f"{BUCKET}=")}
        kept = {} if touched is None else {b: f for b, f in self.folders.items() if int(b) not in touched}
        manifest = {"keys": self.keys, "buckets": self.buckets, "schema": json.loads(self.schema.json()),
                    "folders": kept | {b: folder for b in filled}, "properties": properties}
        self._commit(version, manifest)
        return BucketedTable(self.spark, self.base, version)

    def vacuum(self, keep: int = 2, older_than_s: float = 86_400) -> list[str]:
        """Remove all but the newest ``keep`` manifests, and the bucket folders
        that none of those refers to.  What belongs to no version so far is
        removed only when it is ``older_than_s`` old: its writer may be at work."""
        versions = self._versions()
        held = versions[-max(1, keep):]
        used: dict[str, set[str]] = {}
        for v in held:
            for bucket, folder in BucketedTable(self.spark, self.base, v).folders.items():
                used.setdefault(folder, set()).add(bucket)
        removed = []
        for v in versions[:-max(1, keep)]:
            remove_path(self.spark, f"{self.base}/manifests/{v:012d}.json")
        for folder in self._names(f"{self.base}/data"):
            path = f"{self.base}/data/{folder}"
            if folder not in used:
                fs, p = self._fs(path)
                age = time.time() - fs.getFileStatus(p).getModificationTime() / 1000
                if int(folder.split("-")[0]) <= held[0] or age >= older_than_s:
                    removed.append(path)
                continue
            removed += [f"{path}/{n}" for n in self._names(path)
                        if n.startswith(f"{BUCKET}=") and n.split("=")[1] not in used[folder]]
        for path in removed:
            remove_path(self.spark, path)
        return removed


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def exists(spark: SparkSession, base: str) -> bool:
    try:
        BucketedTable(spark, base)
    except FileNotFoundError:
        return False
    return True


def upsert_latest(table: BucketedTable, rows: DataFrame, order: list | None = None,
                  staged: bool = False) -> BucketedTable:
    """Newest row per key (``cdc_ts_ms``, ties by ``cdc_id``); a late row never
    replaces a newer one, and a batch applied twice changes nothing."""
    return table.update(rows, lambda stored, new: latest_by_key(
        stored.unionByName(new.select(*stored.columns)), table.keys, order), staged=staged)
