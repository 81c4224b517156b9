"""Column expressions for event JSON."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.config import Topics

# The source's time format and the key of an event without an id.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
UNKNOWN_KEY = "unknown"


def event_fields(raw_json: Column, schema=schemas.EVENT) -> Column:
    """The top-level fields of an event as columns; all NULL where the text is no event.

    This is a generator rather than a struct on purpose. A filter on a parsed field is
    pushed through a projection and parses the text again for every field it tests;
    it stops at a generator, so each text is parsed exactly once.
    """
    return F.inline(F.array(F.from_json(raw_json, schema)))


def event_time(created_at: Column) -> Column:
    """NULL, not an error, for text in any other format: one bad row must not end the
    job. The not-null rule on ``event_timestamp`` reports such rows."""
    return F.try_to_timestamp(created_at, F.lit(EVENT_TIME_FORMAT))


def message_key(event_id: Column) -> Column:
    return F.coalesce(event_id, F.lit(UNKNOWN_KEY))


def topics_of(event_type: Column, topics: Topics) -> Column:
    """Array of topics an event goes to: the raw one, then the one of its type if any."""
    lookup = F.create_map(*[F.lit(x) for x in chain(*topics.by_event_type.items())])
    return F.array_compact(F.array(F.lit(topics.raw), lookup[event_type]))
