"""Schemas of every stage, from the event JSON to the star schema."""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

BINARY, BOOLEAN, DATE, INT = BinaryType(), BooleanType(), DateType(), IntegerType()
LONG, STRING, TIMESTAMP = LongType(), StringType(), TimestampType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# The fields of an event that the tables need. Everything else in the
# JSON (the type-dependent payload, URLs, display names) is skipped by the parser
# because it is not declared here.
EVENT = _struct(
    id=STRING,
    type=STRING,
    actor=_struct(id=LONG, login=STRING),
    repo=_struct(id=LONG, name=STRING),
    org=_struct(login=STRING),
    public=BOOLEAN,
    created_at=STRING,
)

# What keying and routing read from an archive line. The last field receives the
# whole line when it is not a JSON object.
ARCHIVE_LINE = _struct(id=STRING, type=STRING, created_at=STRING, _corrupt_record=STRING)

MESSAGE = _struct(
    key=BINARY, value=BINARY, topic=STRING, partition=INT, offset=LONG, timestamp=TIMESTAMP
)

LANDED = StructType([*MESSAGE.fields, StructField("batch", STRING)])

BRONZE = _struct(
    event_id=STRING,
    raw_json=STRING,
    kafka_topic=STRING,
    kafka_partition=INT,
    kafka_offset=LONG,
    kafka_timestamp=TIMESTAMP,
    ingested_at=TIMESTAMP,
    ingestion_date=DATE,
)

SILVER = _struct(
    event_id=STRING,
    event_type=STRING,
    actor_id=LONG,
    actor_login=STRING,
    repo_id=LONG,
    repo_name=STRING,
    org_login=STRING,
    is_public=BOOLEAN,
    event_timestamp=TIMESTAMP,
    ingested_at=TIMESTAMP,
    event_date=DATE,
    event_hour=INT,
)

DIM_REPOS = _struct(
    repo_id=LONG,
    repo_name=STRING,
    first_seen=TIMESTAMP,
    last_seen=TIMESTAMP,
    contributors=LONG,
)

DIM_USERS = _struct(
    actor_id=LONG,
    actor_login=STRING,
    first_seen=TIMESTAMP,
    last_seen=TIMESTAMP,
    repos_touched=LONG,
)

FACT_EVENTS = _struct(
    event_id=STRING,
    event_type=STRING,
    actor_id=LONG,
    repo_id=LONG,
    is_public=BOOLEAN,
    event_timestamp=TIMESTAMP,
    event_date=DATE,
    event_hour=INT,
    ingested_at=TIMESTAMP,
)

AGG_DAILY_ACTIVITY = _struct(
    event_date=DATE,
    repo_id=LONG,
    repo_name=STRING,
    event_type=STRING,
    event_count=LONG,
    unique_actors=LONG,
    ingested_at=TIMESTAMP,
)

TOP_REPOS_BY_STARS = _struct(repo_id=LONG, repo_name=STRING, total_stars=LONG)
