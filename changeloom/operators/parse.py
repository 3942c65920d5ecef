"""Change-event parsing: topic messages -> raw change-log rows.

Semantics of the event consumer, re-expressed as column expressions (no
Python per message):

* the value is decoded as UTF-8 and must be a JSON object; anything else
  (malformed text, arrays, scalars, ``null``, missing value) is rejected;
* an object holding both ``schema`` and ``payload`` is an envelope: parsing
  continues with ``payload`` (which must itself be an object);
* each metadata field (``op``, ``table`` -> source_table, ``ts_ms``) is taken
  from its ``__``-prefixed spelling when that value is truthy, else from the
  plain spelling.  The prefixed key is always removed from the row image;
  the plain key only when the prefixed value was falsy;
* the remaining keys form ``after`` (JSON, value types kept); it is NULL for
  deletes.  ``before`` is always NULL;
* rows missing a required field (op, source_table, ts_ms) are rejected with
  a reason instead of failing the whole batch.

Work is a chain of narrow projections per message: no shuffle, fully
parallel.  Each stage computes its expensive values once as columns, and the
valid / rejected split is a generator rather than a filter, so the optimizer
never copies the JSON parse into a predicate (plans stay linear in size and
every message is parsed once).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions import dedup_map_last, hash60, let, variant_falsy, variant_long
from changeloom.schemas import META_PREFIX, RAW_COLUMNS

_MAP = "map<string,variant>"
# Metadata field -> output column.
_META = [("op", "op"), ("table", "source_table"), ("ts_ms", "ts_ms")]


def _items(text: Column) -> Column:
    """JSON text as the items of an array, each a map of its top-level keys.

    The text is parsed as the only item of an array: text behind the object
    breaks the array or adds an item, so the whole text must be consumed."""
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{_MAP}>")


def _object(items: Column, text: Column) -> Column:
    """The map of the only item of ``_items`` (NULL unless an object).

    An array bracket behind the object would close the wrapper early; only texts
    with such a pair are parsed a second time, inside an object.
    """
    inside = F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), f"struct<x:{_MAP}>")["x"]
    closes_early = text.contains("]") & text.rlike(r"\}\s*\]") & inside.isNull()
    return F.when((F.size(items) == 1) & ~closes_early, _last_wins(F.get(items, F.lit(0))))


def _last_wins(m: Column) -> Column:
    """``dedup_map_last`` of a column; only a map with a repeated key pays for it."""
    once = m.isNull() | (F.size(F.array_distinct(F.map_keys(m))) == F.size(m))
    return F.when(once, m).otherwise(dedup_map_last(m))


# A number, not a string, that a variant would respell: with a fraction, an
# exponent or 19 digits and more.
_RESPELLED = r"[:\[,]\s*-?\d+(\.|[eE]|\d{18,})"


def _image_text(image: Column, text: Column, is_envelope: Column) -> Column:
    """The row image as JSON text.  Numbers keep their kind and value, integers of
    any size and floats alike (1.0 stays a float): where the message has one that
    a variant would change, the values that are not strings are read as text."""
    raw = dedup_map_last(F.when(
        is_envelope, F.from_json(text, "struct<payload:map<string,string>>")["payload"])
        .otherwise(F.from_json(text, "map<string,string>")))

    def exact(r: Column) -> Column:
        def item(k: Column, v: Column) -> Column:
            keep = F.schema_of_variant(v).isin("STRING", "VOID")
            return F.concat(F.to_json(k.cast("variant")), F.lit(":"),
                            F.when(keep, F.to_json(v)).otherwise(r[k]))
        return F.concat(F.lit("{"), F.array_join(F.transform(
            F.map_entries(image), lambda e: item(e["key"], e["value"])), ","), F.lit("}"))

    return F.when(text.rlike(_RESPELLED), let(raw, exact)).otherwise(F.to_json(image))


def parse_change_events(messages: DataFrame, consumed_at: Column | None = None,
                        keep_columns: list[str] | None = None,
                        columns: list[str] | None = None
                        ) -> tuple[DataFrame, DataFrame]:
    """Split messages ``(topic, partition, offset, value[, timestamp])`` into
    ``(valid, rejected)``; see ``parse_messages``.  ``columns`` are those wanted of
    the valid rows (default all); what only others need is not worked out.
    """
    parsed = parse_messages(messages, consumed_at, keep_columns)
    kept = [*(columns or RAW_COLUMNS), *(keep_columns or [])]

    # Split with a generator instead of a filter: filter pushdown would copy
    # the whole parse into the predicate and evaluate it twice per message.
    def split(keep_valid: bool) -> DataFrame:
        reason = F.col("reason")
        position = ["topic", "partition", "offset_value"]
        needed = [*position, *kept] if keep_valid else [*position, "value", "reason", *(keep_columns or [])]
        rows = F.when(reason.isNull() if keep_valid else reason.isNotNull(),
                      F.array(F.struct(*[F.col(c) for c in parsed.columns if c in needed])))
        return parsed.select(F.inline(rows))

    return valid_rows(split(True), keep_columns, columns), rejected_rows(split(False), keep_columns)


def valid_rows(parsed: DataFrame, keep_columns: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """The raw change-log rows of parsed messages without a reason."""
    return (parsed.withColumn("before", F.lit(None).cast("string"))
            .withColumn("cdc_id", hash60("topic", "partition", "offset_value"))
            .select(*(columns or RAW_COLUMNS), *(keep_columns or [])))


def rejected_rows(parsed: DataFrame, keep_columns: list[str] | None = None) -> DataFrame:
    return parsed.select("topic", "partition", "offset_value", "value", "reason", *(keep_columns or []))


def parse_messages(messages: DataFrame, consumed_at: Column | None = None,
                   keep_columns: list[str] | None = None) -> DataFrame:
    """Every message parsed once, with ``reason`` (NULL when it is valid).

    ``valid_rows`` has the raw change-log schema; ``cdc_id`` is a hash of the
    message position, so a replayed message keeps its id.  ``rejected_rows`` has
    ``topic, partition, offset_value, value, reason``.  Of duplicate keys, also
    in nested objects, the last value counts (a session setting of the variant
    reader, switched on here).  ``consumed_at``
    defaults to the current time; pass a column (e.g. the message timestamp)
    for reproducible output.
    """
    keep_columns = keep_columns or []
    messages.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    consumed = consumed_at if consumed_at is not None else F.current_timestamp()
    text = F.col("value").cast("string")
    base = ["topic", "partition", "offset_value", "value", "consumed_at", *keep_columns]

    # Staged projections: each stage computes its expensive values once as
    # columns (a multiply referenced, non-trivial column is not inlined by the
    # optimizer), so the chain stays linear and keeps code generation.  Lambda
    # functions are interpreted, so only rare messages (repeated keys, metadata
    # in an unusual place, respelled numbers) get to an expression with one.
    s1 = messages.select(
        "topic", "partition", F.col("offset").alias("offset_value"), "value",
        consumed.cast("timestamp_ntz").alias("consumed_at"), *keep_columns,
        _items(text).alias("_items"))
    s2 = s1.select(*base, _object(F.col("_items"), text).alias("_top"))
    top = F.col("_top")
    envelope = F.map_contains_key(top, "schema") & F.map_contains_key(top, "payload")
    # A variant sorts the keys of an object; the payload is parsed into a map of
    # its own, in one step, so that the row image keeps their order.
    inner = F.from_json(text, f"struct<payload:{_MAP}>")["payload"]
    s3 = s2.select(*base, top.isNull().alias("_none"), envelope.alias("_envelope"),
                   F.when(envelope, inner).otherwise(top).alias("_inner"))
    s4 = s3.select(*base, "_none", "_envelope",
                   F.when(F.col("_envelope"), _last_wins(F.col("_inner"))).otherwise(F.col("_inner")).alias("_m"))
    m = F.col("_m")
    s5 = s4.select(*base, "_none", "_envelope", "_m",
                   *[(~_falsy(m[META_PREFIX + f])).alias(f"_f_{f}") for f, _ in _META])
    picks = {out: F.when(F.col(f"_f_{f}"), m[META_PREFIX + f]).otherwise(m[f]).alias(f"_v_{out}")
             for f, out in _META}
    s6 = s5.select(*base, "_none", "_envelope", "_m", *[f"_f_{f}" for f, _ in _META],
                   *picks.values(), F.to_json(m).alias("_json"))
    s7 = s6.select(*base, "_none", "_envelope", "_m", "_json", *[f"_f_{f}" for f, _ in _META],
                   _text(F.col("_v_op")).alias("op"), _text(F.col("_v_source_table")).alias("source_table"),
                   variant_long(F.col("_v_ts_ms")).alias("ts_ms"))
    op, table, ts = F.col("op"), F.col("source_table"), F.col("ts_ms")
    reason = (F.when(F.col("_none"), F.lit("not a JSON object"))
              .when(m.isNull(), F.lit("payload is not a JSON object"))
              .when(op.isNull(), F.lit("missing op"))
              .when(table.isNull(), F.lit("missing source_table"))
              .when(ts.isNull(), F.lit("missing or non-integer ts_ms")))
    s8 = s7.select(*base, "_envelope", "_m", "_json", *[f"_f_{f}" for f, _ in _META], "op", "source_table", "ts_ms",
                   _meta_tail(m).alias("_tail"), reason.alias("reason"))
    return s8.select(
        "topic", "partition", "offset_value", "value", "consumed_at", "op", "source_table",
        "ts_ms",
        F.when(op == F.lit("d"), F.lit(None).cast("string"))
         .when(_is_plain(text, F.col("_envelope")), F.concat(F.substring(
             F.col("_json"), F.lit(1), F.length("_json") - F.length("_tail")), F.lit("}")))
         .otherwise(_image_text(_image(m), text, F.col("_envelope"))).alias("after"),
        "reason", *keep_columns)


def _meta_tail(m: Column) -> Column:
    """The end of an object whose last three keys are the metadata that leaves the
    row image: all prefixed, or all plain where no prefixed field is present."""
    def tail(prefix: str) -> Column:
        return F.concat(F.lit(f',"{prefix}op":"'), F.col("op"), F.lit(f'","{prefix}table":"'), F.col("source_table"),
                        F.lit(f'","{prefix}ts_ms":'), F.col("ts_ms").cast("string"), F.lit("}"))
    prefixed, absent = F.lit(True), F.lit(True)
    for f, _ in _META:
        prefixed, absent = prefixed & F.col(f"_f_{f}"), absent & ~F.map_contains_key(m, META_PREFIX + f)
    return F.when(prefixed, tail(META_PREFIX)).when(absent, tail(""))


def _is_plain(text: Column, is_envelope: Column) -> Column:
    """The message is spelled as it is written back, with the metadata at the end of
    the object: then the row image is the text before ``_tail``."""
    spelled = F.when(is_envelope, text.endswith(F.concat(F.lit(',"payload":'), F.col("_json"), F.lit("}")))) \
        .otherwise(text == F.col("_json"))
    return spelled & F.col("_json").endswith(F.col("_tail"))


def _image(m: Column) -> Column:
    """The map without the keys that leave the row image: every prefixed field, and
    the plain field when its prefixed value was falsy."""
    removed = F.array(*[F.lit(META_PREFIX + f) for f, _ in _META],
                      *[F.when(~F.col(f"_f_{f}"), F.lit(f)) for f, _ in _META])
    return let(removed, lambda rm: F.map_filter(
        m, lambda k, v: ~F.coalesce(F.array_contains(rm, k), F.lit(False))))


def _falsy(v: Column) -> Column:
    """``variant_falsy`` of a column; missing values, strings and integers do not
    need its general form."""
    kind = F.schema_of_variant(v)
    return (F.when(v.isNull(), True)
            .when(kind == "STRING", F.try_variant_get(v, "$", "string") == "")
            .when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint") == 0)
            .otherwise(variant_falsy(v)))


def _text(v: Column) -> Column:
    """``variant_text`` of a column."""
    return F.when(~F.is_variant_null(v), F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))
