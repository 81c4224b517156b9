"""Event analytics on Spark: hourly JSON archives to a small star schema."""

from eventlake.config import PipelineConfig, Table, Topics
from eventlake.plans.run import ingest_archive, run_all, run_bronze, run_gold, run_hours, run_silver
from eventlake.session import build_session

__all__ = [
    "PipelineConfig",
    "Table",
    "Topics",
    "build_session",
    "ingest_archive",
    "run_all",
    "run_bronze",
    "run_gold",
    "run_hours",
    "run_silver",
]
