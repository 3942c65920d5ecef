"""changeloom — change-data-capture subscription analytics on Spark.

Change events (JSON messages, static or streaming) are parsed into an
append-only change log, shaped into typed staging relations, and rolled up
into latest-state dimensions, subscription / payment facts, metrics, SCD
Type 2 history, data-quality checks and pipeline monitors.  Every operator is
a ``DataFrame -> DataFrame`` function built from Spark SQL expressions.
"""

from changeloom.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
