"""Archive lines to keyed messages, messages to topics, and the count of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.config import Topics
from eventlake.functions.events import message_key, topics_of


def keyed_messages(lines: DataFrame) -> DataFrame:
    """Events of parsed lines as ``key, value, type``; other lines are dropped. The value
    is the line as it came. The ``position`` of a line stays with it."""
    return lines.where("is_event").select(
        message_key(F.col("id")).alias("key"), "value", "type", *_position(lines)
    )


def _position(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == "position"]


def route(messages: DataFrame, topics: Topics) -> DataFrame:
    """One row per topic a message goes to. Runs inside the scan's tasks, no shuffle."""
    return messages.select(
        "key", "value", F.explode(topics_of(F.col("type"), topics)).alias("topic"), *_position(messages)
    )


def expected_messages(topics: Topics) -> Column:
    """Aggregate over parsed lines: how many messages their events go out as, computed from the events'
    types alone and not from any message."""
    due = F.when(F.col("is_event"), F.size(topics_of(F.col("type"), topics))).otherwise(0)
    return F.coalesce(F.sum(due), F.lit(0)).alias("expected_messages")
