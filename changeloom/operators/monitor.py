"""Pipeline monitors as data: schema drift, type drift, silence, batch
statistics, replay dedup and late arrivals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.functions import ts_to_micros
from changeloom.operators.latest import latest_by_key
from changeloom.operators.neighbors import with_neighbor, with_running_max
from changeloom.schemas import DELETED_MARKER, EXPECTED_COLUMNS, expected_columns_rows

POSITION = ["topic", "partition", "offset_value"]


def expected_columns(spark: SparkSession) -> DataFrame:
    """(source_table, column_name, declared_type) — a fixed, small table."""
    return spark.createDataFrame(expected_columns_rows(),
                                 "source_table string, column_name string, declared_type string")


def schema_drift(raw: DataFrame, expected: DataFrame, since_ts_ms: int | None = None) -> DataFrame:
    """Key inventory of the row images against the declared columns.

    ``status``: ``expected`` (declared and present), ``new`` (present, not
    declared), ``missing`` (declared, not present).  With ``since_ts_ms`` only
    events from that time on are judged, so a column that was renamed or
    dropped earlier shows as missing, and ``last_ts_ms`` tells when a key was
    seen last.  The connector's
    delete marker is metadata, not a column, and is left out.  Keys are counted with
    partial aggregation; the declared table is small and fixed, so it is
    broadcast.
    """
    if since_ts_ms is not None:
        raw = raw.where(F.col("ts_ms") >= since_ts_ms)
    keys = (raw.where(F.col("after").isNotNull())
            .select("source_table", "ts_ms",
                    F.explode(F.json_object_keys("after")).alias("column_name"))
            .where(F.col("column_name") != F.lit(DELETED_MARKER))
            .groupBy("source_table", "column_name")
            .agg(F.count(F.lit(1)).alias("events"), F.min("ts_ms").alias("first_ts_ms"),
                 F.max("ts_ms").alias("last_ts_ms")))
    tables = raw.select("source_table").distinct()
    exp = F.broadcast(expected.select("source_table", "column_name"))
    declared = exp.join(tables, "source_table", "left_semi")
    both = keys.join(declared.withColumn("_declared", F.lit(True)),
                     ["source_table", "column_name"], "full")
    status = (F.when(F.col("events").isNull(), F.lit("missing"))
              .when(F.col("_declared"), F.lit("expected"))
              .otherwise(F.lit("new")))
    return both.select("source_table", "column_name", status.alias("status"),
                       F.coalesce(F.col("events"), F.lit(0)).alias("events"),
                       F.col("first_ts_ms"), F.col("last_ts_ms"))


def type_drift(raw: DataFrame, expected: dict[str, list[tuple[str, str]]] | None = None
               ) -> DataFrame:
    """Per declared column: values present and values that do not cast to
    the declared type.  One aggregation per source table."""
    expected = expected or EXPECTED_COLUMNS
    parts = []
    for table, cols in expected.items():
        schema = "struct<" + ",".join(f"`{c}`:string" for c, _ in cols) + ">"
        j = raw.where(F.col("source_table") == table).select(
            F.from_json("after", schema).alias("j"))
        aggs = []
        for i, (c, t) in enumerate(cols):
            v = F.col(f"j.{c}")
            aggs += [F.count(v).alias(f"n{i}"),
                     F.count(F.when(v.isNotNull() & v.try_cast(t).isNull(), 1)).alias(f"b{i}")]
        rows = F.explode(F.array(*[
            F.struct(F.lit(table).alias("source_table"), F.lit(c).alias("column_name"),
                     F.lit(t).alias("declared_type"), F.col(f"n{i}").alias("values"),
                     F.col(f"b{i}").alias("bad_values"))
            for i, (c, t) in enumerate(cols)]))
        parts.append(j.agg(*aggs).select(rows.alias("r")).select("r.*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def silence_gaps(raw: DataFrame, minutes: int = 30) -> DataFrame:
    """Historic silences: consecutive consumptions of one source table at
    least ``minutes`` apart -> (source_table, gap_start, gap_end,
    minutes_silent).

    A silence of a minute or more can only start at the last event of an
    occupied minute, so the log is first reduced to one row per (table,
    minute) with partial aggregation; the next occupied minute comes from the
    neighbour operator, so a busy table is not one task.
    """
    m = (raw.select("source_table", "consumed_at",
                    F.floor(ts_to_micros(F.col("consumed_at")) / 60_000_000).alias("minute"))
         .groupBy("source_table", "minute")
         .agg(F.min("consumed_at").alias("first_at"), F.max("consumed_at").alias("last_at")))
    n = with_neighbor(m, ["source_table"], ["minute"], ["first_at"], "next", "next_")
    gap_us = ts_to_micros(F.col("next_first_at")) - ts_to_micros(F.col("last_at"))
    return (n.where(F.col("next_first_at").isNotNull() & (gap_us >= minutes * 60_000_000))
            .select("source_table", F.col("last_at").alias("gap_start"),
                    F.col("next_first_at").alias("gap_end"),
                    F.floor(gap_us / 60_000_000).cast("bigint").alias("minutes_silent")))


def last_seen(raw: DataFrame) -> DataFrame:
    """(source_table, first_event, last_event): a mergeable summary of consumption."""
    return raw.groupBy("source_table").agg(F.min("consumed_at").alias("first_event"),
                                           F.max("consumed_at").alias("last_event"))


def merge_seen(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Two summaries as one.  Merging a batch twice changes nothing."""
    return (stored.unionByName(new).groupBy("source_table")
            .agg(F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event")))


def silent_tables(seen: DataFrame, now: Column, minutes: int = 30, tables: list[str] | None = None) -> DataFrame:
    """Tables of a ``last_seen`` summary whose last consumption is at least
    ``minutes`` before ``now``, and those of ``tables`` that never had an event
    (``last_event`` NULL)."""
    last = seen.select("source_table", "last_event")
    if tables:
        declared = seen.sparkSession.createDataFrame([(t,) for t in tables], "source_table string")
        last = declared.join(last, "source_table", "full")
    silent = F.floor((ts_to_micros(now) - ts_to_micros(F.col("last_event"))) / 60_000_000)
    return (last.select("source_table", "last_event", silent.cast("bigint").alias("minutes_silent"))
            .where(F.col("last_event").isNull() | (F.col("minutes_silent") >= minutes)))


def current_silence(raw: DataFrame, now: Column, minutes: int = 30,
                    tables: list[str] | None = None) -> DataFrame:
    """``silent_tables`` of a whole log."""
    return silent_tables(last_seen(raw), now, minutes, tables)


def batch_stats(batch: DataFrame, batch_col: Column | str) -> DataFrame:
    """Events per batch and source table, with a per-batch total row
    (``is_total``, ``source_table`` NULL).  A NULL batch or table is a group
    like any other."""
    b = batch.select(F.col(batch_col) if isinstance(batch_col, str) else batch_col,
                     "source_table")
    name = b.columns[0]
    level = F.grouping_id()
    return (b.rollup(name, "source_table").agg(F.count(F.lit(1)).alias("events"), level.alias("_level"))
            .where("_level < 2")
            .select(name, "source_table", "events", (F.col("_level") == 1).alias("is_total")))


def dedup_offsets(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One row per message position (topic, partition, offset_value).

    Static: the first consumption wins (partial top-1 before the shuffle).
    Streaming: intervals of seen positions decide (``streaming.dedup``), no event
    time.  ``extra`` columns that the position determines let filters on them pass.
    """
    if df.isStreaming:
        from changeloom.streaming.dedup import dedup_positions
        return dedup_positions(df, *POSITION, first_by=["consumed_at", "cdc_id"])
    return latest_by_key(df, [*(extra or []), *POSITION],
                         [F.col("consumed_at").asc(), F.col("cdc_id").asc()])


def late_events(events: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Events consumed after a newer event (higher ``cdc_ts_ms``) of the same
    key -> the event plus ``newer_ts_ms`` (the highest ts seen before it).

    A running maximum (``neighbors.with_running_max``), so a hot key is not one
    task.
    """
    order = ["cdc_consumed_at", "cdc_ts_ms", "cdc_id"]
    return (with_running_max(events, [key], order, F.col("cdc_ts_ms"), "newer_ts_ms", parts)
            .where(F.col("newer_ts_ms") > F.col("cdc_ts_ms")))


def column_renames(raw: DataFrame, since_ts_ms: int, least: float = 0.5) -> DataFrame:
    """Columns that vanished at ``since_ts_ms`` paired with columns that are new
    from then on: (source_table, old_column, new_column, new_values, shared_values).

    A pair shares at least ``least`` of the new column's distinct values, and each
    is the other's best match.  Distinct values are estimated by mergeable theta
    sketches of 4096 entries, one per column (exact below that many values), so
    what is shuffled does not grow with the values, whatever a column holds.
    """
    # Sketches only of tables with a column that vanished and one that is new; the
    # others cannot have a pair.  At most one name per source table gets here.
    spans = (raw.where(F.col("after").isNotNull())
             .select("source_table", (F.col("ts_ms") >= since_ts_ms).alias("recent"),
                     F.explode(F.map_keys(F.from_json("after", "map<string,string>"))).alias("column_name"))
             .where(F.col("column_name") != DELETED_MARKER)
             .groupBy("source_table", "column_name").agg(F.max("recent").alias("present"), F.min("recent").alias("new")))
    tables = [r[0] for r in spans.groupBy("source_table").agg(F.min("present").alias("kept"), F.max("new").alias("new"))
              .where("NOT kept AND new").select("source_table").collect()]
    entries = F.explode(F.from_json("after", "map<string,string>")).alias("column_name", "value")
    cells = (raw.where(F.col("after").isNotNull() & F.col("source_table").isin(*tables))
             .select("source_table", (F.col("ts_ms") >= since_ts_ms).alias("recent"), entries)
             .where((F.col("column_name") != DELETED_MARKER)))
    columns = (cells.groupBy("source_table", "column_name")
               .agg(F.max("recent").alias("present"), F.min("recent").alias("new"),
                    F.theta_sketch_agg(F.when(F.col("value").isNotNull(), F.col("value")), 12).alias("sketch")))
    old = columns.where("NOT present").select("source_table", F.col("column_name").alias("old_column"),
                                              F.col("sketch").alias("old_sketch"))
    new = columns.where("new").select("source_table", F.col("column_name").alias("new_column"),
                                      F.col("sketch").alias("new_sketch"))
    pairs = old.join(new, "source_table").select(
        "source_table", "old_column", "new_column", F.theta_sketch_estimate("new_sketch").alias("new_values"),
        F.theta_sketch_estimate(F.theta_intersection("old_sketch", "new_sketch")).alias("shared_values"))
    best = [F.row_number().over(Window.partitionBy("source_table", c).orderBy(F.desc("shared_values"), o))
            for c, o in (("old_column", "new_column"), ("new_column", "old_column"))]
    return (pairs.where((F.col("new_values") > 0) & (F.col("shared_values") >= least * F.col("new_values")))
            .withColumn("_a", best[0]).withColumn("_b", best[1]).where("_a = 1 AND _b = 1").drop("_a", "_b"))
