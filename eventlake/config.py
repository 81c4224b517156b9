"""Job parameters and the tables they resolve to."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class Table:
    """A catalog table: where it lives, how it is laid out and what identifies a row.

    With a ``path`` the table is external, so its files outlive the session even when
    the catalog does not (see ``sources.catalog.attach``). ``ranged`` tables have a table of the
    key ranges of their partitions beside them (see ``operators.key_ranges``).
    """

    name: str
    partition_by: tuple[str, ...] = ()
    key: str | None = None
    path: str | None = None
    provider: str = "parquet"
    ranged: bool = False


@dataclass(frozen=True)
class Topics:
    raw: str = "events.raw"
    push: str = "events.push"
    pr: str = "events.pr"
    stars: str = "events.stars"

    @property
    def by_event_type(self) -> dict[str, str]:
        # Event types that are also sent to a topic of their own.
        return {
            "PushEvent": self.push,
            "PullRequestEvent": self.pr,
            "WatchEvent": self.stars,
        }


@dataclass(frozen=True)
class PipelineConfig:
    """Parameters of one run.

    warehouse        base folder for the tables; without it they are managed tables
    checkpoint_dir   stream progress; defaults to a folder under ``spark.checkpoint.dir``
    landing          folder of the file-based message log (``message_source="files"``)
    kafka_options    client options passed through, e.g. ``kafka.bootstrap.servers`` and
                     the ``kafka.ssl.*`` settings
    min_partitions   splits Kafka topic partitions into more tasks
    fail_on_data_loss  raise when offsets expired before they were read
    retention        of the file-based message log, e.g. ``24h``: files of the raw topic are deleted once
                     read, and files older than this beside the newest count as expired; the stream's own list of
                     files then stays short
    """

    catalog: str | None = None
    bronze_db: str = "bronze"
    silver_db: str = "silver"
    gold_db: str = "gold"
    warehouse: str | None = None
    checkpoint_dir: str | None = None
    run_date: date | str | None = None
    lookback_days: int = 1
    table_provider: str = "parquet"

    message_source: str = "files"
    landing: str | None = None
    retention: str | None = None
    topics: Topics = field(default_factory=Topics)
    kafka_options: Mapping[str, str] = field(default_factory=dict)
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = None
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: str | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool = True

    def __post_init__(self):
        if self.message_source not in ("files", "kafka"):
            raise ValueError(f"message_source must be 'files' or 'kafka': {self.message_source}")
        if self.lookback_days < 0:
            raise ValueError("lookback_days must not be negative")

    def schema_name(self, db: str) -> str:
        return f"{self.catalog}.{db}" if self.catalog else db

    def schema_path(self, db: str) -> str | None:
        return f"{self.warehouse.rstrip('/')}/{db}" if self.warehouse else None

    def _table(self, db: str, name: str, partition_by=(), key=None, ranged=False) -> Table:
        folder = self.schema_path(db)
        return Table(
            name=f"{self.schema_name(db)}.{name}",
            partition_by=tuple(partition_by),
            key=key,
            path=f"{folder}/{name}" if folder else None,
            provider=self.table_provider,
            ranged=ranged,
        )

    @property
    def raw_events(self) -> Table:
        return self._table(self.bronze_db, "raw_events", ["ingestion_date"])

    @property
    def events(self) -> Table:
        return self._table(self.silver_db, "events", ["event_date", "event_type"], "event_id", ranged=True)

    @property
    def rejects(self) -> Table:
        return self._table(self.silver_db, "rejects", key="event_id")

    @property
    def progress(self) -> Table:
        return self._table(self.silver_db, "progress")

    @property
    def changed_dates(self) -> Table:
        """Event dates that clean loads have touched and the star schema has not seen yet."""
        return self._table(self.silver_db, "changed_dates")

    @property
    def silver_view(self) -> str:
        return f"{self.schema_name(self.silver_db)}.silver_events"

    @property
    def dim_repos(self) -> Table:
        return self._table(self.gold_db, "dim_repos", key="repo_id")

    @property
    def dim_users(self) -> Table:
        return self._table(self.gold_db, "dim_users", key="actor_id")

    @property
    def repo_actors(self) -> Table:
        """Repository and actor of each load's events, from which the dimensions are counted."""
        return self._table(self.gold_db, "repo_actors", ["load"])

    @property
    def dimension_loads(self) -> Table:
        """The loads of ``repo_actors`` that are in the dimensions."""
        return self._table(self.gold_db, "dimension_loads")

    @property
    def fact_events(self) -> Table:
        return self._table(self.gold_db, "fact_events", ["event_date"], "event_id")

    @property
    def agg_daily_activity(self) -> Table:
        return self._table(self.gold_db, "agg_daily_activity", ["event_date"])

    @property
    def top_repos_by_stars(self) -> Table:
        return self._table(self.gold_db, "top_repos_by_stars", key="repo_id")

    @property
    def tables(self) -> tuple[Table, ...]:
        return (
            self.raw_events,
            self.events,
            self.rejects,
            self.progress,
            self.changed_dates,
            self.repo_actors,
            self.dimension_loads,
            self.dim_repos,
            self.dim_users,
            self.fact_events,
            self.agg_daily_activity,
            self.top_repos_by_stars,
        )
