import json
import uuid

import pytest

from eventlake import PipelineConfig, build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "eventlake-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cfg(tmp_path):
    suffix = uuid.uuid4().hex[:8]
    return PipelineConfig(
        bronze_db=f"b_{suffix}",
        silver_db=f"s_{suffix}",
        gold_db=f"g_{suffix}",
        warehouse=str(tmp_path / "tables"),
        checkpoint_dir=str(tmp_path / "progress"),
        landing=str(tmp_path / "landing"),
    )


def event(
    id="1",
    type="WatchEvent",
    actor=1,
    repo=10,
    at="2024-01-15T12:00:00Z",
    login=None,
    name=None,
    **more,
):
    """An event as the archive has it."""
    return json.dumps(
        {
            "id": id,
            "type": type,
            "actor": {"id": actor, "login": login or f"user_{actor}", "url": "u"},
            "repo": {"id": repo, "name": name or f"repo_{repo}", "url": "u"},
            "public": True,
            "created_at": at,
            "payload": {"nested": {"ref": "main"}},
            **more,
        }
    )


BRONZE_INPUT = (
    "raw_json string, ingested_at timestamp, kafka_partition int, kafka_offset bigint"
)


def bronze_rows(spark, rows):
    """Raw rows from texts, or from (text, day of January 2024, partition, offset)."""
    from datetime import datetime

    full = []
    for n, row in enumerate(rows):
        text, day, partition, offset = row if isinstance(row, tuple) else (row, 16, 0, n)
        full.append((text, f"2024-01-{day:02d} 00:00:00", partition, offset))
    df = spark.createDataFrame(
        full, "raw_json string, at string, kafka_partition int, kafka_offset bigint"
    )
    return df.selectExpr(
        "event_id" if "event_id" in df.columns else "cast(null as string) as event_id",
        "raw_json",
        "'events.raw' as kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "cast(at as timestamp) as kafka_timestamp",
        "cast(at as timestamp) as ingested_at",
        "cast(at as date) as ingestion_date",
    )
