"""Order of the events of an entity: created, changed, deleted.

An entity is absent, or present after ``c`` or a snapshot ``r``, and absent
again after ``d``.  Out of order are

* ``before_create``: a change or delete of an entity that was never there,
* ``after_delete``: a change or delete of an entity that was deleted,
* ``second_create``: an insert of an entity that is there.

The state before an event is the operation of the latest earlier ``c``, ``r`` or
``d``: the greatest (place in the order, operation), a fold that partial results
merge into in any grouping.  So the history of one entity may lie in many parts
(``neighbors.with_running_max``) and no task holds a hot one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.operators.neighbors import with_running_max

ORDER = ["cdc_ts_ms", "cdc_id"]


def lifecycle_violations(events: DataFrame, key: str, op: str = "cdc_op", parts: int | None = None) -> DataFrame:
    """Events out of order, with ``violation`` and ``state`` (the operation that
    set the state before it, null if none).  Events without a key are left out."""
    known = events.where(F.col(key).isNotNull())
    mark = F.when(F.col(op).isin("c", "r", "d"),
                  F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(ORDER)], F.col(op).alias("op")))
    rows = with_running_max(known, [key], ORDER, mark, "_state", parts).withColumn("state", F.col("_state.op"))
    changes = F.col(op).isin("u", "d")
    violation = (F.when(changes & F.col("state").isNull(), F.lit("before_create"))
                 .when(changes & (F.col("state") == "d"), F.lit("after_delete"))
                 .when((F.col(op) == "c") & F.col("state").isin("c", "r"), F.lit("second_create")))
    return rows.withColumn("violation", violation).where(F.col("violation").isNotNull()).drop("_state")


def subscription_events(raw: DataFrame) -> DataFrame:
    """(subscription_id, cdc_op, cdc_ts_ms, cdc_id) of all events with an image,
    deletes included."""
    from changeloom.schemas import ID_TYPE
    image = F.from_json("after", "struct<subscription_id:string>")
    return (raw.where((F.col("source_table") == "subscriptions") & F.col("after").isNotNull())
            .select(image["subscription_id"].cast(ID_TYPE).alias("subscription_id"), F.col("op").alias("cdc_op"),
                    F.col("ts_ms").alias("cdc_ts_ms"), "cdc_id"))
