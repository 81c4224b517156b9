from eventlake.functions.events import (
    event_fields,
    event_time,
    message_key,
    topics_of,
)

__all__ = ["event_fields", "event_time", "message_key", "topics_of"]
