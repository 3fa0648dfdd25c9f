"""Raw payloads to typed events: parse (P1-P5), watermark (ST1), validation
(V1-V4) and the rejected-rows split (V3).

Input is any frame with a binary or string ``value`` column (a Kafka record
frame, batch or streaming). Parsing is ``from_json`` in PERMISSIVE mode: unknown
keys are ignored, missing or wrongly typed fields become NULL, and a payload
that is not a JSON object gives an all-NULL row, which the event-time filter
then drops.

The parsed struct is flattened with ``inline`` (a generator) rather than
``select("data.*")``. With a projection, Catalyst pushes every later filter on
the parsed fields (``event_time IS NOT NULL``, the rules' action tests) below
it by inlining the ``from_json`` call into the predicate, so each payload is
parsed once per predicate and once more for the projection. Predicates on
generator output stay above the generator: each payload is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.functions import event_time, is_json_object, missing_fields
from tripwire.schemas import CORE_FIELDS, EVENT_SCHEMA, STRICT_FIELDS

LEVELS = {"core": CORE_FIELDS, "strict": STRICT_FIELDS}

# Reject reasons.
NOT_JSON_OBJECT = "not_json_object"
BAD_TIMESTAMP = "bad_timestamp"
MISSING_FIELDS = "missing_fields"


def _fields(payload: Column) -> Column:
    """Generator: one row holding the 12 event fields parsed from ``payload``."""
    return F.inline(F.array(F.from_json(payload, EVENT_SCHEMA)))


def decode_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Payload text to the 12 event fields plus ``event_time`` (no row dropped)."""
    return raw.select(_fields(F.col(value_col).cast("string"))).withColumn(
        "event_time", event_time("timestamp"))


def parse_events(raw: DataFrame, watermark: str | None = None, value_col: str = "value") -> DataFrame:
    """Parse payloads, keep rows with an event time, optionally set the watermark."""
    parsed = decode_events(raw, value_col).filter(F.col("event_time").isNotNull())
    if watermark:
        parsed = parsed.withWatermark("event_time", watermark)
    return parsed


def validate_events(events: DataFrame, level: str = "strict", default_amount: bool = False,
                    column: str = "errors") -> DataFrame:
    """Add ``column`` (default ``errors``): the names of required fields that are NULL.

    ``strict`` checks every field the event record requires (all but amount);
    ``core`` checks the non-null fields of the Spark schema. With
    ``default_amount`` a NULL amount becomes 0.0 (after ``from_json`` a missing
    key and an explicit null are the same).
    """
    out = events.withColumn(column, missing_fields(LEVELS[level]))
    if default_amount:
        out = out.withColumn("amount", F.coalesce(F.col("amount"), F.lit(0.0)))
    return out


def classify_events(raw: DataFrame, level: str | None = None, value_col: str = "value") -> DataFrame:
    """Decoded events with ``payload`` text and ``reject_reason`` (NULL = valid).

    Reasons, first match wins: ``not_json_object``, ``bad_timestamp``, and with
    a validation ``level`` also ``missing_fields``. The JSON-object test only
    runs for rows that already lack an event time.
    """
    payload = F.col(value_col).cast("string")
    decoded = raw.select(payload.alias("payload"), _fields(payload))
    decoded = decoded.withColumn("event_time", event_time("timestamp"))
    reason = F.when(
        F.col("event_time").isNull(),
        F.when(is_json_object("payload"), F.lit(BAD_TIMESTAMP)).otherwise(F.lit(NOT_JSON_OBJECT)),
    )
    if level is not None:
        reason = reason.when(F.size(missing_fields(LEVELS[level])) > 0, F.lit(MISSING_FIELDS))
    return decoded.withColumn("reject_reason", reason)


def split_events(raw: DataFrame, level: str | None = None, watermark: str | None = None,
                 value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``. Valid rows have the parsed-event columns (and the
    watermark, if given); rejected rows keep ``payload`` and ``reject_reason``.

    Both are filters of one decoded frame: writing both would decode a batch source twice. To keep both sides,
    write them at once with ``streaming.write_split`` and read them back with ``sources.read_split``.
    """
    classified = classify_events(raw, level, value_col)
    valid = classified.filter(F.col("reject_reason").isNull()).drop("payload", "reject_reason")
    if watermark:
        valid = valid.withWatermark("event_time", watermark)
    rejected = classified.filter(F.col("reject_reason").isNotNull())
    return valid, rejected


def rejected_events(raw: DataFrame, level: str | None = None, value_col: str = "value") -> DataFrame:
    """Only the rejected rows of :func:`split_events`."""
    return split_events(raw, level, value_col=value_col)[1]
