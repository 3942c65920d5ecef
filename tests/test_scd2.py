"""SCD2 invariants on the users history built from the change log."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from changeloom.operators import scd2
from changeloom.plans import staging
from changeloom.sources.changelog import change_log

from sf_folders import SF001


def _events(spark):
    return staging.stg_users(change_log(spark, SF001, ["users"]))


def test_one_open_version_and_contiguous(spark):
    h = scd2.build_scd2(_events(spark), "user_id")
    open_per_key = h.groupBy("user_id").agg(F.sum(F.col("is_current").cast("int")).alias("n"))
    assert open_per_key.where("n != 1").count() == 0
    w = Window.partitionBy("user_id").orderBy("valid_from", "cdc_ts_ms", "cdc_id")
    gaps = (h.withColumn("nxt", F.lead("valid_from").over(w))
            .where(~F.col("valid_to").eqNullSafe(F.col("nxt"))))
    assert gaps.count() == 0
    assert h.where(F.col("valid_to") < F.col("valid_from")).count() == 0
    assert h.select("scd_id").distinct().count() == h.count()


def test_incremental_equals_full_and_is_idempotent(spark):
    ev = _events(spark)
    cut = F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    full = scd2.build_scd2(ev, "user_id")
    first = scd2.build_scd2(ev.where(F.col("cdc_consumed_at") < cut), "user_id")
    later = ev.where(F.col("cdc_consumed_at") >= cut)
    once = scd2.apply_scd2(first, later, "user_id")
    twice = scd2.apply_scd2(once, later, "user_id")
    cols = sorted(full.columns)
    rows = lambda d: sorted(map(tuple, d.select(*cols).collect()), key=repr)
    assert rows(once) == rows(full)
    assert rows(twice) == rows(full)


def test_changes_only_drops_unchanged_versions(spark):
    ev = _events(spark)
    h = scd2.build_scd2(ev, "user_id", tracked=["email", "plan_id"])
    w = Window.partitionBy("user_id").orderBy("valid_from", "cdc_ts_ms", "cdc_id")
    same = (h.withColumn("pe", F.lag("email").over(w)).withColumn("pp", F.lag("plan_id").over(w))
            .where(F.col("pe").eqNullSafe(F.col("email")) & F.col("pp").eqNullSafe(F.col("plan_id"))))
    assert same.count() == 0
    assert h.count() < ev.count()


def test_hard_deletes_close_open_versions(spark):
    h = scd2.build_scd2(_events(spark), "user_id")
    live = h.select("user_id").distinct().where("user_id % 2 = 0")
    out = scd2.invalidate_hard_deletes(h, live, "user_id", F.lit("2031-01-01 00:00:00"))
    assert out.where("is_current AND user_id % 2 = 1").count() == 0
    assert out.where("is_current").count() == live.count()


def _event(spark, rows):
    schema = "user_id bigint, plan_id int, cdc_ts_ms bigint, cdc_id bigint, cdc_consumed_at string"
    return spark.createDataFrame(rows, schema).withColumn("cdc_consumed_at", F.col("cdc_consumed_at").cast("timestamp_ntz"))


def test_late_event_between_equal_states(spark):
    """A late plan 2 between two equal plan 1 events makes the second one a
    version again."""
    stored = [(1, 1, 1, 11, "2024-01-01 00:00:00"), (1, 1, 3, 13, "2024-01-03 00:00:00")]
    late = [(1, 2, 2, 12, "2024-01-02 00:00:00")]
    log = _event(spark, stored + late)
    first = scd2.build_scd2(_event(spark, stored), "user_id", tracked=["plan_id"])
    assert first.count() == 1
    got = scd2.apply_scd2(first, _event(spark, late), "user_id", tracked=["plan_id"], log=log)
    assert [r.plan_id for r in got.orderBy("valid_from").collect()] == [1, 2, 1]
    with pytest.raises(ValueError):
        scd2.apply_scd2(first, _event(spark, late), "user_id", tracked=["plan_id"])


def test_equal_ids_of_different_events_are_both_kept(spark):
    first = scd2.build_scd2(_event(spark, [(1, 1, 1, 7, "2024-01-01 00:00:00")]), "user_id")
    more = _event(spark, [(1, 2, 2, 7, "2024-01-02 00:00:00"), (1, 1, 1, 7, "2024-01-05 00:00:00")])
    got = scd2.apply_scd2(first, more, "user_id", current_keys=_event(spark, []), closed_at=F.lit("2031-01-01 00:00:00"))
    assert [r.plan_id for r in got.orderBy("valid_from").collect()] == [1, 2]
    assert got.where("is_current").count() == 0


def _random_events(seed, n):
    """Events of six keys in a few states, with ties in time and unchanged
    states; some are replayed later."""
    import random
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), rng.randint(1, 3), rng.randint(1, 20), k,
             f"2024-01-{rng.randint(1, 12):02d} 0{rng.randint(0, 3)}:00:00") for k in range(n)]
    replays = [(*r[:4], f"2024-02-{rng.randint(1, 9):02d} 00:00:00") for r in rng.sample(rows, n // 5)]
    return rng, rows, replays


@pytest.mark.parametrize("tracked", [None, ["plan_id"]])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_splicing_random_batches_equals_a_full_build(spark, seed, tracked):
    """Late, replayed and tied events, in three batches of arbitrary rows."""
    rng, rows, replays = _random_events(seed, 60)
    full = scd2.build_scd2(_event(spark, rows), "user_id", tracked=tracked)
    rng.shuffle(rows)
    batches = [rows[:30], rows[30:45] + replays[:6], rows[45:] + replays]
    # the stored history holds the replays' copies only if their originals came before
    history, log = scd2.build_scd2(_event(spark, batches[0]), "user_id", tracked=tracked), list(batches[0])
    for batch in batches[1:]:
        log += batch
        history = scd2.apply_scd2(history, _event(spark, batch), "user_id", tracked=tracked,
                                  log=_event(spark, log) if tracked else None)
        history = spark.createDataFrame(history.collect(), history.schema)
    cols = sorted(full.columns)
    state = lambda d: sorted(map(tuple, d.select(*cols).collect()), key=repr)
    assert state(history) == state(full)


def test_only_the_neighbours_of_new_events_are_cut_anew(spark):
    """A thousand versions and one newer event: one stored version is touched."""
    stored = [(1, k % 3, k, k, f"2024-01-01 {k // 3600:02d}:{k // 60 % 60:02d}:{k % 60:02d}") for k in range(1000)]
    history = scd2.build_scd2(_event(spark, stored + [(2, 1, 5, 5000, "2024-01-01 00:00:05")]), "user_id")
    near = lambda t: scd2.affected(history, spark.createDataFrame([(1, t)], "user_id bigint, t string").select(
        "user_id", F.col("t").cast("timestamp_ntz").alias("_since")), "user_id").where("_near").count()
    assert near("2024-01-02 00:00:00") == 1
    # 00:16:29.5: the version of 00:16:29 and the ten after it
    assert near("2024-01-01 00:16:29.5") == 11
    after = scd2.apply_scd2(history, _event(spark, [(1, 7, 2000, 6000, "2024-01-02 00:00:00")]), "user_id")
    ends = lambda d: {(r.scd_id, r.valid_to) for r in d.select("scd_id", "valid_to").collect()}
    assert len(ends(after)) == 1002 and len(ends(after) & ends(history)) == 1000


def test_a_version_closed_by_a_delete_stays_closed(spark):
    first = scd2.build_scd2(_event(spark, [(1, 1, 1, 1, "2024-01-01 00:00:00")]), "user_id")
    closed = scd2.invalidate_hard_deletes(first, _event(spark, []), "user_id", F.lit("2024-01-05 00:00:00"))
    got = scd2.apply_scd2(closed, _event(spark, [(1, 2, 2, 2, "2024-01-09 00:00:00")]), "user_id").orderBy("valid_from").collect()
    assert [(str(r.valid_to)[:10], r.is_current) for r in got] == [("2024-01-05", False), ("None", True)]
