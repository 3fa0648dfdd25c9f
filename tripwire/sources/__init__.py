from tripwire.sources.kafka import kafka_source_options, read_alerts_kafka, read_events_kafka, read_kafka
from tripwire.sources.parquet import read_alert_updates, read_alerts, read_events, read_split
from tripwire.sources.tables import event_records, read_event_records, read_event_slices, table_path

__all__ = [
    "event_records", "kafka_source_options", "read_alert_updates", "read_alerts", "read_alerts_kafka", "read_event_records",
    "read_event_slices", "read_events", "read_events_kafka", "read_kafka", "read_split", "table_path",
]
