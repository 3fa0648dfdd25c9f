"""The driver's ``events`` table as a stream of raw event payloads.

The engine's input is a Kafka-shaped record frame (``key``, binary ``value``
holding one JSON event). The test tables hold typed rows instead, so this
adapter renders each row as the JSON payload a producer would send. It is a
per-row projection (no shuffle), so it works the same on a batch read and on a
streaming file source, and it scales with the table.

Two kinds of malformed records are injected so the reject path has work on
every row count: events whose id is a multiple of 97 carry a payload that is
not JSON, and those whose id is a multiple of 89 carry an unparsable
timestamp. Every row is still processed; none is filtered out here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.schemas import EVENT_FIELDS

# Mapping of the table's event types to event actions.
ACTION_OF_TYPE = {
    "error": "login_failed",
    "purchase": "transaction_success",
    "view": "page_view",
    "click": "product_click",
    "signup": "login_success",
}
# Derived payload attributes (own choice; the table has no such columns).
DEVICE_TYPES = ("phone", "laptop", "kiosk")  # by k % 3
COUNTRIES = ("NO", "PT", "KE", "PE")  # by user_id % 4
CITIES = ("Bergen", "Porto", "Nairobi", "Lima")  # by user_id % 4
USER_AGENT = "agent/1"
NOT_JSON_EVERY = 97
BAD_TIMESTAMP_EVERY = 89
PARTIAL_EVERY = 101
# The driver's events table. Given explicitly so a read does not
# open a Parquet footer to infer it.
EVENTS_TABLE_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _action(event_type: Column) -> Column:
    (first_type, first_action), *rest = ACTION_OF_TYPE.items()
    out = F.when(event_type == first_type, F.lit(first_action))
    for t, a in rest:
        out = out.when(event_type == t, F.lit(a))
    return out.otherwise(event_type)


def event_records(table: DataFrame, partial: bool = False) -> DataFrame:
    """``events`` rows -> ``(key STRING, value BINARY)`` payload records. With ``partial`` single fields are missing too:
    the i-th field (from 0) from the payloads of event ids that are a multiple of ``PARTIAL_EVERY + i``."""
    k = F.get_json_object("props", "$.k").cast("int")
    uid = F.col("user_id")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    fields = [
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_id") % BAD_TIMESTAMP_EVERY == 0, F.lit("bad-ts")).otherwise(iso).alias("timestamp"),
        F.concat(F.lit("usr_"), uid.cast("string")).alias("user_id"),
        F.concat(F.lit("sess_"), uid.cast("string")).alias("session_id"),
        F.concat_ws(".", F.lit("10.0"), (uid % 8).cast("string"), (k % 4).cast("string")).alias("ip_address"),
        _pick(DEVICE_TYPES, k % 3).alias("device_type"),
        _pick(COUNTRIES, uid % 4).alias("location_country"),
        _pick(CITIES, uid % 4).alias("location_city"),
        _action(F.col("event_type")).alias("action"),
        F.concat(F.lit("/"), F.col("event_type")).alias("url_path"),
        F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0)).alias("amount"),
        F.lit(USER_AGENT).alias("user_agent"),
    ]
    if partial:  # NULL fields are left out of the JSON text
        fields = [F.when(F.col("event_id") % (PARTIAL_EVERY + i) != 0, f).alias(n) for i, (f, (n, _, _)) in enumerate(zip(fields, EVENT_FIELDS, strict=True))]
    payload = F.to_json(F.struct(*fields))
    value = F.when(F.col("event_id") % NOT_JSON_EVERY == 0, F.lit("not json")).otherwise(payload)
    return table.select(
        F.concat(F.lit("usr_"), uid.cast("string")).alias("key"),
        value.cast("binary").alias("value"),
    )


def spread(df: DataFrame, parts: int, key: str = "event_id") -> DataFrame:
    """Fan a small input out to ``parts`` tasks (no-op for ``parts == 0``).

    A Parquet row group is the smallest split, so a small single-row-group file
    is read by one task and every narrow step after it (JSON rendering and
    parsing, window expansion, partial aggregation) would run on one core. A
    hash repartition on the unique ``key`` spreads that work evenly and is
    deterministic, so a retried task gets the same rows (round-robin would
    need a sort first to be). It is the caller's choice: a table of many row
    groups needs none.
    """
    return df.repartition(parts, key) if parts else df


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_event_records(spark: SparkSession, sf_dir: str, streaming: bool = False,
                       max_files_per_trigger: int | None = None, parts: int = 0, partial: bool = False) -> DataFrame:
    """Payload records from ``{sf_dir}/events.parquet``, as a batch or a stream.

    The streaming form is a file source over the directory restricted to the
    events file, with the table's fixed schema. ``parts`` fans the rows out
    (see :func:`spread`); 0 leaves the scan as it is. ``partial``: see :func:`event_records`.
    """
    path = table_path(sf_dir, "events")
    scan = spark.read.schema(EVENTS_TABLE_SCHEMA).parquet(path)
    if not streaming:
        return event_records(spread(scan, parts), partial)
    reader = spark.readStream.schema(EVENTS_TABLE_SCHEMA).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return event_records(spread(reader.parquet(sf_dir), parts), partial)


def read_event_slices(spark: SparkSession, sf_dir: str, n: int = 3, held_every: int = 11) -> list[DataFrame]:
    """The payload records of the whole table in ``n`` slices, as a feed would deliver them with delays: equal parts of
    the table's time, but every ``held_every``-th event id comes only with the last slice."""
    table = spark.read.schema(EVENTS_TABLE_SCHEMA).parquet(table_path(sf_dir, "events"))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = table.agg(F.min(micros), F.max(micros)).first()
    place = F.call_function("div", (micros - F.lit(low)) * n, F.lit(high - low + 1))
    place = F.when(F.col("event_id") % held_every == 0, F.lit(n - 1)).otherwise(place)
    return [event_records(table.filter(place == k)) for k in range(n)]
