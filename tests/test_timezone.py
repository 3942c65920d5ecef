"""Results do not depend on the session time zone."""

from changeloom.plans import staging
from changeloom.sources.changelog import change_log

from sf_folders import SF001


def test_session_zone_independent(spark):
    def rows():
        r = change_log(spark, SF001, ["subscriptions", "plans"])
        a = staging.stg_subscriptions(r).collect()
        b = staging.stg_plans(r).collect()
        return sorted(map(tuple, a), key=repr), sorted(map(tuple, b), key=repr)
    utc = rows()
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        la = rows()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == la
