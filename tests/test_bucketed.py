"""Bucketed tables: touched buckets only, commit by rename, retention."""

import glob
import tempfile

import pytest
from pyspark.sql import functions as F

from changeloom.operators import scd2
from changeloom.plans import marts, staging
from changeloom.sources.bucketed import BucketedTable, ConcurrentUpdate, exists, upsert_latest
from changeloom.sources.changelog import change_log

from sf_folders import SF001

SCHEMA = "user_id bigint, email string, cdc_ts_ms bigint, cdc_id bigint"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _table(spark, n=200, buckets=32):
    base = tempfile.mkdtemp(prefix="cl-bucketed-") + "/t"
    return BucketedTable.create(_rows(spark, [(k, f"u{k}@x", 100, k) for k in range(n)]), base, ["user_id"], buckets)


def _state(table):
    return {r.user_id: (r.email, r.cdc_ts_ms) for r in table.read().collect()}


def test_update_rewrites_touched_buckets_only(spark):
    t = _table(spark)
    after = upsert_latest(t, _rows(spark, [(7, "new@x", 200, 1), (8, "late@x", 50, 2), (500, "first@x", 10, 3)]))
    state = _state(after)
    assert len(state) == 201 and state[7] == ("new@x", 200) and state[8] == ("u8@x", 100) and state[500][0] == "first@x"
    changed = {b for b in after.folders if after.folders[b] != t.folders.get(b)}
    assert 0 < len(changed) <= 3
    assert all(after.folders[b] == t.folders[b] for b in set(t.folders) - changed)
    # The old version is still what it was; reading a bucket reads its files only.
    assert len(_state(t)) == 200 and _state(t)[7] == ("u7@x", 100)
    one = int(sorted(changed)[0])
    assert all(f"_bucket={one}/" in f for f in after.read([one]).inputFiles())
    # Applied again, nothing changes; no rows, no version.
    again = upsert_latest(after, _rows(spark, [(7, "new@x", 200, 1)]))
    assert _state(again) == state
    assert upsert_latest(again, _rows(spark, [])).version == again.version


def test_killed_writer_leaves_the_old_version(spark):
    t = _table(spark)

    class Killed(Exception):
        pass

    class Dying(BucketedTable):
        def _commit(self, version, manifest):
            raise Killed

    dying = Dying(spark, t.base)
    with pytest.raises(Killed):
        upsert_latest(dying, _rows(spark, [(7, "new@x", 200, 1)]))
    opened = BucketedTable(spark, t.base)
    assert opened.version == t.version and _state(opened) == _state(t)
    # What it left stays while it may be at work, and goes after that.
    left = set(glob.glob(f"{t.base}/data/*")) - {f"{t.base}/data/{f}" for f in t.folders.values()}
    assert len(left) == 1
    assert opened.vacuum() == [] and len(opened.vacuum(older_than_s=0)) == 1
    assert not set(glob.glob(f"{t.base}/data/*")) & left and _state(opened) == _state(t)


def test_second_writer_of_a_version_fails(spark):
    t = _table(spark, 20, 4)
    other = BucketedTable(spark, t.base)
    upsert_latest(t, _rows(spark, [(1, "a@x", 200, 1)]))
    with pytest.raises(ConcurrentUpdate):
        upsert_latest(other, _rows(spark, [(1, "b@x", 300, 1)]))
    assert _state(BucketedTable(spark, t.base))[1][0] == "a@x"
    with pytest.raises(ConcurrentUpdate):
        BucketedTable.create(_rows(spark, []), t.base, ["user_id"])


def test_vacuum_keeps_what_kept_versions_need(spark):
    t = _table(spark, 50, 8)
    for k in range(5):
        t = upsert_latest(t, _rows(spark, [(1, f"v{k}@x", 200 + k, 1)]))
    before = _state(t)
    assert len(t.vacuum(keep=2)) == 4       # the bucket of versions 1 to 4
    assert _state(BucketedTable(spark, t.base)) == before and before[1] == ("v4@x", 204)
    assert BucketedTable(spark, t.base)._versions() == [5, 6]
    assert _state(BucketedTable(spark, t.base, 5))[1] == ("v3@x", 203)
    used = {f"{t.base}/data/{f}/_bucket={b}" for v in (5, 6) for b, f in BucketedTable(spark, t.base, v).folders.items()}
    assert set(glob.glob(f"{t.base}/data/*/_bucket=*")) == used


def test_odd_tables(spark):
    base = tempfile.mkdtemp(prefix="cl-bucketed-") + "/t"
    assert not exists(spark, base)
    empty = BucketedTable.create(_rows(spark, []), base, ["user_id"], 4)
    assert exists(spark, base) and empty.read().count() == 0
    t = upsert_latest(empty, _rows(spark, [(None, "n@x", 1, 1), (None, "m@x", 2, 1), (3, None, 1, 1), (3, None, 1, 1)]))
    assert _state(t) == {None: ("m@x", 2), 3: (None, 1)}
    # A merge that empties a bucket leaves no entry for it.
    gone = t.update(_rows(spark, [(3, None, 0, 0)]), lambda stored, new: stored.join(new, "user_id", "left_anti"))
    assert _state(gone) == {None: ("m@x", 2)}


def test_scd2_history_in_buckets(spark):
    ev = staging.stg_users(change_log(spark, SF001, ["users"]))
    cut = F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    base = tempfile.mkdtemp(prefix="cl-bucketed-") + "/users"
    first = scd2.build_scd2(ev.where(F.col("cdc_consumed_at") < cut), "user_id")
    t = BucketedTable.create(first, base, ["user_id"], 16)
    t = t.update(ev.where(F.col("cdc_consumed_at") >= cut), lambda h, new: scd2.apply_scd2(h, new, "user_id"))
    full = scd2.build_scd2(ev, "user_id")
    rows = lambda d: sorted(map(tuple, d.select(*sorted(full.columns)).collect()), key=repr)
    assert rows(t.read()) == rows(full)
    assert marts.dim_users(ev).count() == t.read().where("is_current").count()
