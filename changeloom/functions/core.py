"""Scalar column expressions.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage code generation wherever the surrounding operator does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash60(*parts: Column | str) -> Column:
    """Deterministic 60-bit id: first 15 hex digits of md5 over ``a|b|...``.

    Used instead of a global serial (a serial needs one ordering task).  The
    same value is reproducible in any SQL engine with ``md5``.
    """
    key = F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


# All epoch conversions are NTZ arithmetic from the epoch, so they do not
# depend on the session time zone (UTC wall clock in, UTC wall clock out).
def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def micros_to_ts(c: Column) -> Column:
    """Epoch microseconds -> timestamp_ntz (UTC wall clock)."""
    return F.timestamp_add("MICROSECOND", c, _epoch())


def millis_to_ts(c: Column) -> Column:
    """Epoch milliseconds -> timestamp_ntz (UTC wall clock)."""
    return F.timestamp_add("MICROSECOND", c * 1000, _epoch())


def ts_to_micros(c: Column) -> Column:
    """timestamp_ntz -> epoch microseconds."""
    return F.timestamp_diff("MICROSECOND", _epoch(), c.cast("timestamp_ntz"))


def flag(cond: Column) -> Column:
    """Searched CASE to boolean: true when ``cond`` is true, else false.

    A NULL input gives false, unlike a bare comparison which gives NULL.
    """
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def let(expr: Column, body) -> Column:
    """Bind ``expr`` to a lambda variable and evaluate ``body(var)``.

    Referencing the variable many times does not copy ``expr`` into the
    expression tree, which keeps plans small when an optimizer rule (filter
    pushdown, projection collapsing) substitutes column definitions.
    """
    return F.transform(F.array(expr), body)[0]


def dedup_map_last(m: Column) -> Column:
    """Keep the last occurrence of every duplicate key of a map.

    JSON objects with repeated keys parse into a map that holds both; the
    event producer's semantics are "last one wins".
    """
    def body(mm: Column) -> Column:
        keys = F.map_keys(mm)
        kept = let(keys, lambda ks: F.filter(
            F.map_entries(mm),
            lambda e, i: ~F.array_contains(F.slice(ks, i + 2, F.size(ks)), e["key"])))
        # Fast path: no repeated key (the common case) keeps the map as is.
        return (F.when(mm.isNull() | (F.size(F.array_distinct(keys)) == F.size(mm)), mm)
                .otherwise(F.map_from_entries(kept)))
    return let(m, body)


def variant_text(v: Column) -> Column:
    """Variant as text: strings unquoted, other values as JSON text; a JSON
    null is NULL."""
    return let(v, lambda x: F.when(
        ~F.is_variant_null(x), F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x))))


def variant_long(v: Column) -> Column:
    """Variant as bigint (numbers or numeric strings), NULL when it is not."""
    return F.try_variant_get(v, "$", "bigint")


def variant_falsy(v: Column) -> Column:
    """Truthiness of a JSON value the way a dynamic language tests it.

    Falsy: missing, JSON null, empty string, numeric zero, false, empty
    object, empty array.  Non-empty strings (including "0") are truthy.
    """
    def body(x: Column) -> Column:
        text = F.to_json(x)
        numeric_zero = (F.substring(text, 1, 1) != F.lit('"')) & \
            (F.try_variant_get(x, "$", "double") == F.lit(0.0))
        return (x.isNull()
                | text.isin("null", '""', "{}", "[]", "false")
                | F.coalesce(numeric_zero, F.lit(False)))
    return let(v, body)
