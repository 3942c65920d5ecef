"""Column-expression helpers shared by the operators (all JVM-side)."""

from changeloom.functions.core import (  # noqa: F401
    hash60, micros_to_ts, millis_to_ts, ts_to_micros, flag, dedup_map_last,
    variant_falsy, variant_text, variant_long, let,
)
