"""Column helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n`` (a null counts as empty)."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def partitions_for(df: DataFrame) -> int:
    """Shuffle partitions of the session, the unit the operators size by."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
