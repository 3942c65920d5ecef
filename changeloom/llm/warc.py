"""WARC archives written by a deterministic sharded writer, and read back.

Records are put in order of (page id, payload digest); prefix sums of their
sizes cut that order into shards of about ``shard_bytes`` of payload, so the
shards depend on the data alone.  One task writes a shard: a new file begins
when the compressed size reaches ``file_bytes``; each record is a gzip member
of its own.  Headers, record ids and digests are made anew from the content.

Files are written under temporary names.  Spark commits the list of the files
of the attempts that succeeded (the manifest), then the files are renamed to
their final names; leftovers of failed attempts are in no manifest, and readers
take the files that the manifest names.

Records whose payloads are equal and of at least ``revisit_bytes`` become
revisits of the one that comes first.

Defined results: null html is an empty payload; a null url gives no target
URI; a null page id sorts first and is written empty; of equal rows the first
is the response and the others revisit it; an empty table gives no file; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.session import scratch_path, stage

SHARD_BYTES = 64 << 20
FILE_BYTES = 16 << 20
REVISIT_BYTES = 100
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "shard bigint, seq bigint, temporary string, name string, records bigint, bytes bigint, sha256 string"
RECORDS = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint, file string")
SAFE = "!#$%&'()*+,/:;=?@[]~-._"


def record_id(page_id, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
             ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def _page_record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """A response with the whole payload, or a revisit with the HTTP head only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"),
               ("WARC-Record-ID", f"<{record_id(page_id, digest)}>"), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=SAFE)))
    headers += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-ID", "" if page_id is None else str(page_id))]
    if url is not None:
        headers.append(("X-Page-URL", quote(url, safe="")))
    if refers_to is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", f"<{record_id(refers_to[0], digest)}>"),
                    ("X-Refers-To-Page-ID", "" if refers_to[0] is None else str(refers_to[0]))]
    headers.append(("Content-Type", "application/http; msgtype=response"))
    return _record(headers, http + payload if refers_to is None else http)


def _member(data: bytes, level: int) -> bytes:
    """A gzip member without name or time, so equal records are equal bytes."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _write(folder: str, file_bytes: int, level: int, date: str):
    """Write rows that come sorted by (shard, page, digest, refers_to rows first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        attempt = TaskContext.get().taskAttemptId()
        out, shard, seq, key, seen = None, None, 0, None, 0
        done: list[tuple] = []

        def begin():
            name = f"shard-{shard:06d}-{seq:04d}.warc.gz"
            temporary = f"{name}.{attempt}-{uuid.uuid4().hex}.tmp"
            f = {"stream": store.open_output_stream(f"{base}/{temporary}"), "sha": hashlib.sha256(),
                 "bytes": 0, "records": 0, "temporary": temporary, "name": name}
            info = _record([("WARC-Type", "warcinfo"),
                            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
                            ("WARC-Date", date), ("WARC-Filename", name),
                            ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            put(f, _member(info, level))
            return f

        def put(f, data: bytes):
            f["stream"].write(data)
            f["sha"].update(data)
            f["bytes"] += len(data)

        def end(f):
            f["stream"].close()
            done.append((shard, seq, f["temporary"], f["name"], f["records"], f["bytes"], f["sha"].hexdigest()))

        for batch in batches:
            names = ("shard", "page_id", "url", "html", "digest", "refers_to", "grouped")
            for now, page, url, html, digest, refers_to, grouped in zip(*(batch.column(c).to_pylist() for c in names)):
                if now != shard:
                    if out:
                        end(out)
                    out, shard, seq = None, now, 0
                if out and out["bytes"] >= file_bytes:
                    end(out)
                    out, seq = None, seq + 1
                out = out or begin()
                # equal rows (same page and payload): all but the first are revisits
                seen = seen + 1 if (page, digest) == key else 0
                key = (page, digest)
                payload = (html or "").encode("utf-8")
                first = (refers_to,) if grouped and (seen or refers_to != page) else None
                put(out, _member(_page_record(page, url, payload, digest, first, date), level))
                out["records"] += 1
            if done:
                yield _rows(done, ("shard", "seq", "temporary", "name", "records", "bytes", "sha256"),
                            "iissiis")
                done.clear()
        if out:
            end(out)
        if done:
            yield _rows(done, ("shard", "seq", "temporary", "name", "records", "bytes", "sha256"), "iissiis")
    return run


def _rows(rows: list[tuple], names, kinds: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64() if k == "i" else pa.string()) for c, k in zip(zip(*rows), kinds)], names=list(names))


def _commit(folder: str):
    """Rename the manifest's files; a repeated task finds them renamed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for b in batches:
            for temporary, name in zip(b.column("temporary").to_pylist(), b.column("name").to_pylist()):
                if store.get_file_info(f"{base}/{temporary}").type != fs.FileType.NotFound:
                    store.move(f"{base}/{temporary}", f"{base}/{name}")
                elif store.get_file_info(f"{base}/{name}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{name}: neither the temporary nor the final file exists")
            yield b
    return run


def plan_records(pages: DataFrame, shard_bytes: int = SHARD_BYTES, revisit_bytes: int = REVISIT_BYTES,
                 ) -> tuple[DataFrame, list[tuple]]:
    """The digests that occur more than once (digest, refers_to, grouped) and
    the first (page_id, digest) of every shard after the first.

    The cuts are one pair per ``shard_bytes`` of payload: a list of at most
    total size / shard_bytes pairs (use shards of 1 GB at 100 TB).  The prefix
    sums run over blocks of the order, then over block totals."""
    slim = stage(pages.select("page_id", "digest", F.octet_length(F.coalesce("html", F.lit(""))).cast("long")
                              .alias("n_bytes")), "warc-slim")
    groups = (slim.where(F.col("n_bytes") >= revisit_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("grouped")).where("grouped > 1"))
    marks = stage(groups, "warc-groups")
    ordered = stage(slim.repartitionByRange("page_id", "digest").sortWithinPartitions("page_id", "digest")
                    .withColumn("block", F.spark_partition_id()), "warc-order")
    totals = ordered.groupBy("block").agg(F.sum("n_bytes").alias("total"))
    bases = totals.select("block", (F.sum("total").over(Window.partitionBy(F.lit(0)).orderBy("block"))
                                    - F.col("total")).alias("base"))
    within = Window.partitionBy("block").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = (ordered.withColumn("before", F.coalesce(F.sum("n_bytes").over(within), F.lit(0)))
              .join(F.broadcast(bases), "block")
              .withColumn("shard", F.floor((F.col("base") + F.col("before")) / shard_bytes)))
    cuts = (placed.groupBy("shard").agg(F.min(F.struct(F.coalesce("page_id", F.lit(-2**63)).alias("p"),
                                                       F.col("digest").alias("d"))).alias("first"))
            .orderBy("shard").collect())
    return marks, [(r["first"]["p"], r["first"]["d"]) for r in cuts[1:]]


def _shards(cuts: list[tuple]):
    """Shard number of every row by binary search in the cuts."""
    from bisect import bisect_right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = zip(b.column("page_id").to_pylist(), b.column("digest").to_pylist())
            shard = [bisect_right(cuts, (-2**63 if p is None else p, d)) for p, d in pairs]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard, pa.int64())], names=[*b.schema.names, "shard"])
    return run


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES,
               revisit_bytes: int = REVISIT_BYTES, level: int = 6, date: str = DATE) -> DataFrame:
    """Write the archives into ``folder`` (shared, any file system pyarrow
    opens) and return the manifest, which is kept in ``folder/_manifest``."""
    spark = pages.sparkSession
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                         F.col(html_col).alias("html"),
                         F.sha2(F.coalesce(F.col(html_col), F.lit("")).cast("binary"), 256).alias("digest"))
    marks, cuts = plan_records(pages, shard_bytes, revisit_bytes)
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    rows = (pages.join(marks, "digest", "left")
            .select("page_id", "url", "html", "digest", "refers_to", F.col("grouped").isNotNull().alias("grouped"))
            .mapInArrow(_shards(cuts), "page_id bigint, url string, html string, digest string, "
                        "refers_to bigint, grouped boolean, shard bigint"))
    written = (rows.repartitionById(len(cuts) + 1, F.col("shard").cast("int"))
               .sortWithinPartitions("shard", "page_id", "digest", "url")
               .mapInArrow(_write(folder, file_bytes, level, date), MANIFEST))
    tentative = stage(written, "warc-manifest")
    tentative.mapInArrow(_commit(folder), MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    return spark.read.schema(tentative.schema).parquet(f"{folder}/_manifest")


def records_of(stream, size: int = 1 << 16) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of every record of a WARC stream of gzip members."""
    engine, text, raw = zlib.decompressobj(31), bytearray(), b""
    ended = False
    while True:
        if not raw and not ended:
            raw = stream.read(size)
            ended = not raw
        if raw:
            text += engine.decompress(raw)
            raw = engine.unused_data if engine.eof else b""
            if not engine.eof:
                continue
            engine = zlib.decompressobj(31)
        elif ended:
            if text:
                raise ValueError("the file ends within a record")
            return
        yield _parse(bytes(text))
        text.clear()


def _parse(record: bytes) -> tuple[dict, bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    size = int(headers["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its header")
    block = rest[:size]
    if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError("a block differs from its digest")
    return headers, block


def _read(folder: str, step: int = 2000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote
        names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "file")
        store, base = fs.FileSystem.from_uri(folder)
        for b in batches:
            for name in b.column("name").to_pylist():
                rows = []
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for headers, block in records_of(stream):
                        kind = headers["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.rsplit(b"Content-Length: ", 1)[1])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{name}: a payload differs from its digest")
                        page, first = headers["X-Page-ID"], headers.get("X-Refers-To-Page-ID", "")
                        url = headers.get("X-Page-URL")
                        rows.append((int(page) if page else None, None if url is None else unquote(url), length,
                                     digest, kind, int(first) if first else None, name))
                        if len(rows) == step:
                            yield _rows(rows, names, "isissis")
                            rows = []
                if rows:
                    yield _rows(rows, names, "isissis")
    return run


def read_warc(spark: SparkSession, folder: str, files_per_task: int = 4) -> DataFrame:
    """The page records of a folder written by ``write_warc``: what the
    manifest lists, with lengths and digests verified."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    tasks = max(1, -(-manifest.count() // files_per_task))
    return (manifest.select("name").repartition(tasks, "name")
            .mapInArrow(_read(folder), RECORDS))


def round_trip(pages: DataFrame, **params) -> DataFrame:
    """Write all pages under the shared folder and read the records back."""
    folder = scratch_path(pages.sparkSession, "warc")
    if "://" not in folder and folder.startswith("/"):
        folder = f"file://{folder}"
    write_warc(pages, folder, **params)
    return read_warc(pages.sparkSession, folder)
