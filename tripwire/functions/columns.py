"""Column expressions shared by the operators. All are built-in Spark
expressions evaluated in the JVM; none runs Python."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(text: Column | str) -> Column:
    """ISO-8601 text to TIMESTAMP; unparsable text gives NULL (ANSI-safe).

    Offsets (``+02:00``, ``Z``) are honoured; text without one is read in the
    session zone, which the engine pins to UTC.
    """
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def as_ntz(c: Column | str) -> Column:
    """TIMESTAMP to TIMESTAMP_NTZ in the session zone (UTC): a zone-free value."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def nan_to_null(c: Column | str) -> Column:
    """NaN becomes NULL, so ``sum`` skips it instead of turning into NaN
    (and ``NaN >= x`` being true would raise a false alert)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def is_json_object(text: Column | str) -> Column:
    """True when the text is a JSON object; false for arrays, scalars and garbage.

    ``from_json`` to a struct cannot tell garbage from ``[]`` (both give an all-NULL
    row); to a map it gives NULL for what is no object, and takes repeated keys.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.from_json(text, "map<string,string>").isNotNull()


def missing_fields(fields: Iterable[str]) -> Column:
    """Array of the names of the given fields that are NULL (empty when none)."""
    return F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))


def watermark_safe(df, cond: Column) -> Column:
    """A row filter that keeps every input row feeding the event-time watermark.

    On a stream Catalyst would push a plain predicate below the watermark node,
    so only matching events would advance it and quiet rules would hold windows
    open. A predicate that also references ``event_time`` stays above it. On a
    batch frame the plain predicate is returned, so it can still reach the scan
    (partition pruning on ``action``).
    """
    if df.isStreaming:
        return F.when(F.col("event_time").isNotNull(), cond).otherwise(F.lit(False))
    return cond
