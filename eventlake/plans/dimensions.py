"""Dimensions kept up to date at the cost of what is new.

Every load of events adds the combinations of repository and actor it has, with the times of their
first and last event, to a table that only grows. Smallest, largest and distinct values of such rows are those
of the events, however often an event is in them, so distinct counts add up over loads and a load that
is added again after a failure changes nothing. A run reads the combinations of keys that occur in loads
it has not seen, and no events.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import PipelineConfig, Table
from eventlake.operators import merge
from eventlake.plans import gold
from eventlake.sources import catalog

#: Loads that are kept apart before they are joined into one.
MOST_LOADS = 200


def _with_load(rows: DataFrame) -> DataFrame:
    return rows.withColumn("load", F.lit(uuid.uuid4().hex))


def add_load(spark: SparkSession, cfg: PipelineConfig, events: DataFrame) -> None:
    """Add the combinations of new events. To be called before the events are in the fact, so that a run
    that dies in between finds them missing there and adds them again."""
    merge.append(spark, _with_load(gold.combinations(events)), cfg.repo_actors)


def start_over(spark: SparkSession, cfg: PipelineConfig, events: DataFrame) -> None:
    """Replace all combinations by those of all events."""
    merge.rebuild(spark, _with_load(gold.combinations(events)), cfg.repo_actors)


def _loads(spark: SparkSession, table: Table) -> set[str]:
    """The loads of the table, of which there are few (``MOST_LOADS``)."""
    return {r[0].removeprefix("load=") for r in spark.sql(f"SHOW PARTITIONS {table.name}").collect()}


def _applied(spark: SparkSession, cfg: PipelineConfig, latest_name: bool) -> set[str] | None:
    """The loads that are in the dimensions, None if those have to be built anew."""
    tables = (cfg.dimension_loads, cfg.dim_repos, cfg.dim_users)
    if not all(catalog.exists(spark, t) for t in tables):
        return None
    rows = catalog.read(spark, cfg.dimension_loads).collect()
    return {r["load"] for r in rows} if all(r["latest_name"] == latest_name for r in rows) else None


def update(spark: SparkSession, cfg: PipelineConfig, latest_name: bool = False) -> None:
    """Bring both dimensions up to date with all loads."""
    log = catalog.read(spark, cfg.repo_actors)
    loads, applied = _loads(spark, cfg.repo_actors), _applied(spark, cfg, latest_name)
    new = sorted(loads - (applied or set()))
    if applied is not None and not new:
        return
    for table, build in ((cfg.dim_repos, gold.dim_repos), (cfg.dim_users, gold.dim_users)):
        if applied is None:
            merge.rebuild(spark, build(log, latest_name), table)
            continue
        touched = log.where(F.col("load").isin(new)).select(table.key).distinct()
        touched = touched.where(F.col(table.key).isNotNull())
        kept = catalog.read(spark, table).join(touched, table.key, "left_anti")
        changed = build(log.join(touched, table.key, "left_semi"), latest_name)
        merge.rebuild(spark, kept.unionByName(changed), table)
    if len(loads) > MOST_LOADS:
        first_seen, last_seen = gold.SEEN
        names = [c for c in log.columns if c not in (*gold.SEEN, "load")]
        joined = log.groupBy(*names).agg(F.min(first_seen).alias(first_seen), F.max(last_seen).alias(last_seen))
        merge.rebuild(spark, _with_load(joined), cfg.repo_actors)
        new, applied = sorted(_loads(spark, cfg.repo_actors)), None
    done = spark.createDataFrame([(x, latest_name) for x in new], "load string, latest_name boolean")
    if applied is None:
        merge.overwrite(done, cfg.dimension_loads)
    else:
        merge.append(spark, done, cfg.dimension_loads)
