"""SCD Type 2 history from change events (timestamp strategy).

Every staged event of a key is one version, ordered by
``(updated_at, cdc_ts_ms, cdc_id)``; ``valid_from`` is its ``updated_at``,
``valid_to`` the next version's ``valid_from`` (NULL while current).  This
keeps "every change preserved as a new row" for keys with many events per
run.  Optional: change-only compaction on tracked columns, incremental
apply limited to touched keys, and hard-delete invalidation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions import ts_to_micros
from changeloom.operators.latest import latest_by_key
from changeloom.operators.neighbors import with_neighbor

ORDER_TAIL = ["cdc_ts_ms", "cdc_id"]


def _scd_id(key: str) -> Column:
    return F.md5(F.concat_ws("|", F.col(key), ts_to_micros(F.col("valid_from")),
                             F.col("cdc_id")))


def _intervals(versions: DataFrame, key: str, updated_at: str) -> DataFrame:
    order = [updated_at] + ORDER_TAIL
    v = with_neighbor(versions, [key], order, [updated_at], "next", "_next_")
    return (v.withColumn("updated_at", F.col(updated_at))
            .withColumn("valid_from", F.col(updated_at))
            .withColumn("valid_to", F.col("_next_" + updated_at))
            .drop("_next_" + updated_at)
            .withColumn("is_current", F.col("valid_to").isNull())
            .withColumn("scd_id", _scd_id(key)))


def _compact(events: DataFrame, key: str, updated_at: str, tracked: list[str]) -> DataFrame:
    """Drop events whose tracked columns equal the previous event's."""
    order = [updated_at] + ORDER_TAIL
    src = events.withColumn("_one", F.lit(1))
    p = with_neighbor(src, [key], order, tracked + ["_one"], "prev", "_prev_")
    same = None
    for c in tracked:
        eq = F.col(c).eqNullSafe(F.col("_prev_" + c))
        same = eq if same is None else same & eq
    keep = F.col("_prev__one").isNull() | ~same
    return p.where(keep).drop("_one", *[f"_prev_{c}" for c in tracked + ["_one"]])


def build_scd2(events: DataFrame, key: str, updated_at: str = "cdc_consumed_at",
               tracked: list[str] | None = None) -> DataFrame:
    """Full history from staged events (one version per event).

    With ``tracked``, an event that changes none of the tracked columns
    relative to the previous event of the key is not a new version.
    """
    ev = _compact(events, key, updated_at, tracked) if tracked else events
    return _intervals(ev, key, updated_at)


def affected(history: DataFrame, since: DataFrame, key: str) -> DataFrame:
    """``history`` with ``_near``: the versions that an event of ``since`` (one row
    a key: the key and ``_since``, its earliest new time) can change.  Those are
    the version that was valid at that time and the ones after it."""
    first = since.select(F.col(key).alias("_key"), "_since")
    return (history.join(first, F.col(key).eqNullSafe(F.col("_key")), "left")
            .withColumn("_near", F.col("_since").isNotNull()
                        & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("_since")))))


def _spliced(history: DataFrame, events: DataFrame, key: str, updated_at: str,
             identity: list[str], version_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(versions that stay as they are, rows to cut into versions anew)."""
    seen = history.select(*[F.col(c).alias(f"_o_{c}") for c in [*identity, updated_at]])
    copy = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in identity])
    fresh = events.join(seen, copy & (F.col(f"_o_{updated_at}") <= F.col(updated_at)), "left_anti")
    flagged = affected(history, fresh.groupBy(key).agg(F.min(updated_at).alias("_since")), key)
    # A copy that was consumed earlier than the stored one takes its place.
    cut = latest_by_key(flagged.where("_near").select(*version_cols).unionByName(fresh), identity,
                        [F.col(updated_at).asc()])
    return flagged.where("NOT _near").select(*history.columns), cut


def _spliced_changes(history: DataFrame, events: DataFrame, log: DataFrame, key: str, updated_at: str,
                     identity: list[str], version_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """The same for a change-only history: what it dropped comes from ``log``."""
    keys = events.select(F.col(key).alias("_touched")).distinct()
    known = log.join(keys, F.col(key).eqNullSafe(F.col("_touched")), "left_semi").select(*version_cols, F.lit(False).alias("_new"))
    pool = latest_by_key(known.unionByName(events.withColumn("_new", F.lit(True))), identity,
                         [F.col(updated_at).asc(), F.col("_new").desc()])
    place = F.struct(F.col(updated_at), *[F.col(c) for c in ORDER_TAIL])
    since = pool.where("_new").groupBy(F.col(key).alias("_key")).agg(F.min(place).alias("_since"))
    # From the last version before the first new event on; that version differs
    # from the one before it whatever follows, so it can begin the cut.
    start = (history.join(since, F.col(key).eqNullSafe(F.col("_key"))).groupBy("_key", "_since")
             .agg(F.max(F.when(place < F.col("_since"), place)).alias("_start"))
             .unionByName(since.select("_key", "_since", F.lit(None).cast(pool.select(place).schema[0].dataType).alias("_start")))
             .groupBy("_key").agg(F.max("_start").alias("_start"), F.lit(True).alias("_hit")))
    after = F.col("_hit") & (F.col("_start").isNull() | (place >= F.col("_start")))
    flagged = (history.join(start, F.col(key).eqNullSafe(F.col("_key")), "left")
               .withColumn("_near", F.coalesce(after, F.lit(False))))
    region = pool.join(start, F.col(key).eqNullSafe(F.col("_key"))).where(after)
    return flagged.where("NOT _near").select(*history.columns), region.select(*version_cols)


def apply_scd2(history: DataFrame, events: DataFrame, key: str,
               updated_at: str = "cdc_consumed_at", tracked: list[str] | None = None,
               log: DataFrame | None = None, current_keys: DataFrame | None = None,
               closed_at: Column | None = None) -> DataFrame:
    """Next history = stored history + new events, spliced in.

    Only the version that was valid when a key's first new event came, and
    those after it, are cut anew together with the events; for events newer than
    all stored ones that is the open version alone.  All other versions pass
    through as they are.  A replayed event (equal in all but its time) is not a
    version twice, so a re-run changes nothing; if the copy was consumed earlier
    than the stored one, it takes its place.  A version closed by a hard delete
    before the key's first new event stays closed at that time.

    A change-only history (``tracked``) has dropped the events that changed
    nothing, and a late event can make one of them a version again; so it also
    needs ``log``, all staged events so far (the new ones may be among them), of
    which only the touched keys are read.  With ``current_keys`` the open versions
    of other keys are closed at ``closed_at``.
    """
    if tracked and log is None:
        raise ValueError("a change-only history needs the staged event log to place late events")
    version_cols = [c for c in history.columns
                    if c not in ("updated_at", "valid_from", "valid_to", "is_current", "scd_id")]
    # The id is a hash: rows are the same event only if all else is equal too.
    identity = [c for c in version_cols if c != updated_at]
    new = latest_by_key(events.select(*version_cols), identity, [F.col(updated_at).asc()])
    if tracked:
        stay, cut = _spliced_changes(history, new, log, key, updated_at, identity, version_cols)
    else:
        stay, cut = _spliced(history, new, key, updated_at, identity, version_cols)
    out = stay.unionByName(build_scd2(cut, key, updated_at, tracked).select(*history.columns))
    return out if current_keys is None else invalidate_hard_deletes(out, current_keys, key, closed_at)


def invalidate_hard_deletes(history: DataFrame, current_keys: DataFrame, key: str,
                            closed_at: Column) -> DataFrame:
    """Close the open version of every key missing from ``current_keys``."""
    keys = current_keys.select(F.col(key).alias("_live")).distinct()
    flagged = history.join(keys, history[key] == keys["_live"], "left")
    gone = F.col("is_current") & F.col("_live").isNull()
    return (flagged
            .withColumn("valid_to", F.when(gone, closed_at.cast("timestamp_ntz"))
                        .otherwise(F.col("valid_to")))
            .withColumn("is_current", F.col("is_current") & ~gone)
            .drop("_live"))
