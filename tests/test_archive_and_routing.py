import gzip
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from conftest import event

from eventlake import PipelineConfig, ingest_archive
from eventlake.config import Topics
from eventlake.functions import topics_of
from eventlake.operators import expected_messages, keyed_messages, route
from eventlake.plans.run import DeliveryError
from eventlake.sources import archive, messages
from pyspark.sql import functions as F

NOW = datetime(2024, 1, 15, 0, 30, tzinfo=timezone.utc)

LINES = [
    event("1", "PushEvent"),
    "{bad",
    "",
    "   ",
    '{"id":"12","type":"Q"',
    "[1,2]",
    "null",
    "17",
    '"text"',
    '[{"id":"9"}]',
    '{"id":7,"type":"PullRequestEvent"}',
    '{"id":"10","id":"11","type":"WatchEvent"}',
    '{"type":"WatchEvent"}',
    '{"id":null,"type":"ForkEvent"}',
    '{"id":"20"}',
    "{}",
]


@pytest.fixture
def lines(spark):
    df = spark.createDataFrame([(t,) for t in LINES + [None]], "value string")
    return archive.parse_lines(df)


def test_hour_selection():
    assert archive.previous_hour(NOW) == ("2024-01-14", 23)
    assert archive.resolve_hour(now=NOW) == ("2024-01-14", 23)
    assert archive.resolve_hour("2024-01-15", 0) == ("2024-01-15", 0)
    for args in (("2024-01-15", None), (None, 3)):
        with pytest.raises(ValueError):
            archive.resolve_hour(*args)
    with pytest.raises(ValueError):
        archive.resolve_hour("2024-01-15", 24)


def test_hour_is_not_padded_in_file_names():
    assert archive.archive_path("/a/", "2024-01-15", 5) == "/a/2024-01-15-5.json.gz"
    paths = archive.archive_paths("/a", datetime(2024, 1, 15, 22), datetime(2024, 1, 16, 1))
    assert [p.removeprefix("/a/2024-01-") for p in paths] == [
        "15-22.json.gz",
        "15-23.json.gz",
        "16-0.json.gz",
        "16-1.json.gz",
    ]


def test_only_json_objects_are_events(lines):
    kept = [r["value"] for r in lines.where("is_event").collect()]
    assert kept == [LINES[i] for i in (0, 10, 11, 12, 13, 14, 15)]
    assert lines.where("is_event is null").count() == 0


def test_keys(lines):
    keys = [r["key"] for r in keyed_messages(lines).collect()]
    assert keys == ["1", "7", "11", "unknown", "unknown", "20", "unknown"]


def test_value_is_the_line_unchanged(lines):
    assert keyed_messages(lines).first()["value"] == LINES[0]


def test_routing(lines):
    routed = route(keyed_messages(lines), Topics())
    counts = {r["topic"]: r["count"] for r in routed.groupBy("topic").count().collect()}
    assert counts == {"events.raw": 7, "events.push": 1, "events.pr": 1, "events.stars": 2}


def test_topic_lookup(spark):
    df = spark.createDataFrame([("WatchEvent",), ("Other",), (None,)], "type string")
    got = [r[0] for r in df.select(topics_of(F.col("type"), Topics(raw="r", stars="s"))).collect()]
    assert got == [["r", "s"], ["r"], ["r"]]


def test_expected_messages(lines):
    routed = route(keyed_messages(lines), Topics())
    assert lines.agg(expected_messages(Topics())).first()[0] == 11 == routed.count()
    assert lines.where("false").agg(expected_messages(Topics())).first()[0] == 0


def _write_hour(folder, day, hour, lines):
    folder.mkdir(exist_ok=True)
    path = folder / f"{day}-{hour}.json.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines))
    return str(path)


def test_ingest_counts_everything(spark, cfg, tmp_path):
    path = _write_hour(tmp_path / "arc", "2024-01-15", 12, LINES)
    counts = ingest_archive(spark, cfg, path)
    assert counts == {
        "source_lines": 16,
        "malformed_lines": 9,
        "expected_messages": 11,
        "messages": 11,
        "raw_messages": 7,
        "delivered": 11,
    }
    log = spark.read.parquet(cfg.landing)
    assert log.where("topic = 'events.stars'").count() == 2
    assert {"key", "value", "partition", "offset", "timestamp"} <= set(log.columns)
    again = ingest_archive(spark, cfg, path)
    assert again["delivered"] == 11
    assert spark.read.parquet(cfg.landing).count() == 22


def test_ingest_of_a_file_without_events(spark, cfg, tmp_path):
    path = _write_hour(tmp_path / "arc", "2024-01-15", 13, ["{bad", ""])
    assert ingest_archive(spark, cfg, path)["delivered"] == 0


def test_ingest_limit_takes_the_first_events(spark, cfg, tmp_path):
    lines = [event(str(i), at=f"2024-01-15T12:00:{59 - i:02d}Z") for i in range(20)]
    ingest_archive(spark, cfg, _write_hour(tmp_path / "arc", "2024-01-15", 12, lines), limit=3)
    raw = spark.read.parquet(cfg.landing).where("topic = 'events.raw'")
    assert {bytes(r["key"]).decode() for r in raw.collect()} == {"19", "18", "17"}


@pytest.mark.parametrize("log", ["files", "kafka"])
def test_lost_messages_fail_the_run(spark, cfg, tmp_path, monkeypatch, log):
    """A writer that is given one message less, and a broker's writer in place of which none is here."""
    path = _write_hour(tmp_path / "arc", "2024-01-15", 12, LINES)
    if log == "kafka":
        cfg = replace(cfg, message_source="kafka", kafka_options={"kafka.bootstrap.servers": "h:1"})
    send = lambda df, c: df.write.format("noop").mode("overwrite").save()
    monkeypatch.setattr(messages, "_send", send)
    assert ingest_archive(spark, cfg, path)["delivered"] == 11
    assert ingest_archive(spark, cfg, path, limit=2)["delivered"] == 4
    write = messages.write_messages
    monkeypatch.setattr(
        messages, "write_messages", lambda df, c, b: write(df.where("topic != 'events.pr'"), c, b)
    )
    with pytest.raises(DeliveryError, match="sent 11, delivered 10"):
        ingest_archive(spark, cfg, path)


def test_messages_lost_after_the_writer_fail_the_run(spark, cfg, tmp_path, monkeypatch):
    path = _write_hour(tmp_path / "arc", "2024-01-15", 12, LINES)
    landed = messages.landed_messages
    monkeypatch.setattr(
        messages, "landed_messages", lambda *a: landed(*a).where("topic != 'events.pr'")
    )
    with pytest.raises(DeliveryError, match="sent 11, delivered 10"):
        ingest_archive(spark, cfg, path)


def _shuffles(df):
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def test_few_files_are_spread_over_the_cluster(spark, tmp_path):
    path = _write_hour(tmp_path / "arc", "2024-01-15", 12, LINES)
    lines = archive.read_archive(spark, path)
    assert lines.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert _shuffles(lines)


def test_files_of_even_size_are_not_shuffled_but_a_dominant_one_is(spark, tmp_path):
    for hour in range(8):
        _write_hour(tmp_path / "arc", "2024-01-15", hour, LINES)
    lines = archive.read_archive(spark, str(tmp_path / "arc"))
    assert not _shuffles(lines) and lines.count() == 8 * len(LINES)
    many = [event(str(n * 7919), "PushEvent", n * 31, n * 17) for n in range(400)]
    _write_hour(tmp_path / "arc", "2024-01-15", 8, many)
    lines = archive.read_archive(spark, str(tmp_path / "arc"))
    assert _shuffles(lines) and lines.count() == 8 * len(LINES) + 400


def test_kafka_options():
    cfg = PipelineConfig(
        message_source="kafka",
        kafka_options={"kafka.bootstrap.servers": "h:1", "kafka.security.protocol": "SSL"},
        min_partitions=400,
        max_offsets_per_trigger=50_000,
    )
    assert messages.kafka_read_options(cfg) == {
        "kafka.bootstrap.servers": "h:1",
        "kafka.security.protocol": "SSL",
        "subscribe": "events.raw",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "50000",
        "minPartitions": "400",
    }
    with pytest.raises(ValueError):
        PipelineConfig(message_source="queue")
