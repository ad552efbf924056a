from .events import (
    EVENTS_SCHEMA,
    FEED_SCHEMA,
    MESSAGE_SCHEMA,
    feed_actions,
    message_actions,
    read_events,
)
from .publish import drop_published, publish_table
from .sink import RESULT_SCHEMA, ensure_table, load_days, load_result

__all__ = [
    "EVENTS_SCHEMA",
    "FEED_SCHEMA",
    "MESSAGE_SCHEMA",
    "RESULT_SCHEMA",
    "drop_published",
    "ensure_table",
    "feed_actions",
    "load_days",
    "load_result",
    "message_actions",
    "publish_table",
    "read_events",
]
