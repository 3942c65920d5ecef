"""Join helpers: anti-join finders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
            ignore_null: bool = False) -> DataFrame:
    """Child rows whose ``key`` has no match in ``parent`` (left anti join).

    With ``ignore_null`` a NULL key is not reported (foreign-key semantics);
    otherwise it counts as an orphan (left-join-is-null semantics).  The
    parent side is reduced to its distinct keys first, so the join shuffles
    one row per parent key.
    """
    pk = parent_key or key
    keys = parent.select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull()).distinct()
    src = child.where(F.col(key).isNotNull()) if ignore_null else child
    return src.join(keys, src[key] == keys["_pk"], "left_anti")
