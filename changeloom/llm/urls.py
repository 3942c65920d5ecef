"""URL filters as a sort-merge range join.

A host is keyed by its labels in reverse (``a.example.org`` is
``org.example.a.``), so that a rule's host stands for the interval of all keys
that begin with it: the host and its subdomains.  Intervals either nest or are
disjoint.  Keys and interval starts are cut by the same borders, sorted, and
swept once: the sweep keeps a stack of the rules whose interval is open, opens
rules as their key comes up and drops those that are passed.  For every url the
stack is searched for rules whose path begins the url's path; the longest wins.

Borders come from a bounded sample and only balance the work; they hold the id
hash besides the key, so urls of one host spread over as many parts as their
number asks for.  A rule goes to every part its interval touches.

Defined results: a null url, or one without ``://``, has an empty host and path
and fits no rule; repeated rows are judged alike; an empty table gives an empty
result; without rules every url gets the default verdict; other columns of the
input are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import partitions_for

SAMPLE_PER_PART = 40
# Fixed values of the registered query: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, upper.lower()),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def host_key(host: Column) -> Column:
    """Reversed labels, each followed by a dot; '' for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _after(key: str) -> str:
    """The first key behind all keys that begin with ``key`` (which ends in a
    dot; no label byte sorts between '.' and '/')."""
    return key[:-1] + "/"


def _part_of_rows(borders: list[tuple[str, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, salts = b.column("key").to_pylist(), b.column("salt").to_pylist()
            parts = [bisect_right(borders, pair) for pair in zip(keys, salts)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(parts, pa.int32())],
                                             names=[*b.schema.names, "part"])
    return run


def _parts_of_rules(borders: list[tuple[str, int]]):
    """A rule for every part that its interval touches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                first = bisect_left(borders, (row["key"],))
                last = bisect_left(borders, (_after(row["key"]),))
                out += [(row["key"], row["host"], row["path"], row["verdict"], p) for p in range(first, last + 1)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), [*[pa.string()] * 4, pa.int32()])],
                    names=["key", "host", "path", "verdict", "part"])
    return run


def _sweep(default: str):
    """Sweep rows sorted by (part, key, rules first).  An entry of the stack:
    the key, its rules by path, and the path lengths, the longest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack, last = None, [], None
        for b in batches:
            out = []
            for row in zip(*(b.column(c).to_pylist() for c in
                             ("part", "key", "is_url", "page_id", "host", "path", "verdict"))):
                now, key, is_url, page, host, path, verdict = row
                if now != part:
                    part, stack, last = now, [], None
                if key != last:
                    while stack and not key.startswith(stack[-1][0]):
                        stack.pop()             # passed
                    last = key
                if not is_url:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, []))
                    known, sizes = stack[-1][1:]
                    known[path] = max(known[path][0], verdict) if path in known else verdict, host
                    if len(path) not in sizes:
                        sizes.append(len(path))
                        sizes.sort(reverse=True)
                    continue
                best = None
                for _, known, sizes in stack if key else ():
                    fit = next((path[:n] for n in sizes if n <= len(path) and path[:n] in known), None)
                    if fit is not None:
                        rule = known[fit][1] + fit
                        best = max(best or (0,), (len(rule), rule, known[fit][0]))
                out.append((page, host, path, best and best[1], best[2] if best else default))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), [pa.int64(), *[pa.string()] * 4])],
                    names=["page_id", "host", "path", "rule", "verdict"])
    return run


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", parts: int | None = None) -> DataFrame:
    """page_id, host, path, rule (host and path of the longest rule that fits,
    else null) and verdict of every row.

    ``rules(host, path, verdict)``; of equally long rules the last by text wins.
    """
    parts = parts or partitions_for(pages)
    host, path = host_and_path(F.col(url_col))
    rows = (pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
            .withColumn("key", host_key(F.col("host")))
            .withColumn("salt", F.xxhash64("page_id", "path")))
    # Borders: quantiles of a sample of about SAMPLE_PER_PART rows a part.
    n = rows.select("page_id").count()
    step = max(1, n // (parts * SAMPLE_PER_PART))
    drawn = sorted((r["key"], r["salt"]) for r in rows.where(F.pmod("salt", F.lit(step)) == 0)
                   .select("key", "salt").distinct().collect())
    borders = sorted({drawn[len(drawn) * k // parts] for k in range(1, parts)}) if drawn else []

    urls = rows.mapInArrow(_part_of_rows(borders), "page_id bigint, host string, path string, key string, "
                           "salt bigint, part int").drop("salt").withColumns(
        {"is_url": F.lit(True), "verdict": F.lit(None).cast("string")})
    lower = F.translate(F.col("host"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    opened = (rules.select(host_key(lower).alias("key"), lower.alias("host"), "path", "verdict")
              .where("host <> ''").dropDuplicates()
              .mapInArrow(_parts_of_rules(borders), "key string, host string, path string, verdict string, part int")
              .withColumns({"is_url": F.lit(False), "page_id": F.lit(None).cast("long")}))
    return (urls.unionByName(opened).repartition(len(borders) + 1, "part")
            .sortWithinPartitions("part", "key", "is_url")
            .mapInArrow(_sweep(default), "page_id bigint, host string, path string, rule string, verdict string"))
