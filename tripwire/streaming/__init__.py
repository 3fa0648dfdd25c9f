from tripwire.streaming.job import (
    PipelineSpec,
    await_pipeline,
    run_once,
    start_pipeline,
    stop_all,
    watermark_report,
)
from tripwire.streaming.live import (
    AlertFanOut,
    AlertLog,
    EventStore,
    LatestView,
    NewestRows,
    TrailingStore,
    WindowStore,
    recent_alert_rows,
    recent_event_rows,
)
from tripwire.streaming.replay import replay
from tripwire.streaming.sinks import (
    kafka_sink_options,
    write_alert_updates,
    write_alerts,
    write_alerts_kafka,
    write_console,
    write_events,
    write_events_kafka,
    write_rejected,
    write_split,
)

__all__ = [
    "AlertFanOut", "AlertLog", "EventStore", "LatestView", "NewestRows", "TrailingStore", "WindowStore", "recent_alert_rows", "recent_event_rows", "replay",
    "PipelineSpec", "await_pipeline", "kafka_sink_options", "run_once", "start_pipeline", "stop_all",
    "watermark_report", "write_alert_updates", "write_alerts", "write_alerts_kafka", "write_console", "write_events", "write_events_kafka", "write_rejected", "write_split",
]
