"""Times the headline queries and one run over all stages; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import inputs  # noqa: E402
from checks.queries import QUERIES, archive_to_star_schema, hours_on_history  # noqa: E402
from eventlake import build_session  # noqa: E402
from eventlake.session import use_utc  # noqa: E402

HEADLINE = (
    "keyed_messages",
    "route_topics",
    "bronze_stream",
    "silver_parse",
    "silver_clean",
    "silver_dedupe",
    "silver_create",
    "dedupe_by_key",
    "dim_repos",
    "dim_users",
    "fact_events",
    "agg_daily_activity",
    "top_repos_topk",
    "events_by_type",
    "star_join",
    "incremental_highwater",
    "incremental_affected_dates",
    "agg_daily_incremental",
    "fact_incremental_safe",
    "merge_insert_only",
    "merge_upsert",
    "merge_upsert_table",
    "insert_overwrite_table",
    "compact_partitions",
    "dq_not_null",
    "dq_unique",
    "dq_audit",
)


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_utc(spark)

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("events_by_type")  # starts the executor and opens the files
    times = {name: seconds(lambda name=name: run(name)) for name in HEADLINE}
    times["archive_to_gold"] = seconds(lambda: archive_to_star_schema(spark, sf_dir, "bench"))
    # One hour more on short and on long history; not part of the total.
    on_history = {
        f"hourly_increment_since_{first}": hours_on_history(spark, sf_dir, first, seconds)
        for first in ("2024-01-28", "2024-01-01")
    }
    events = inputs.table(spark, sf_dir, "events").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries and one run over all stages",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {**times, **on_history},
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "events": events,
                "archive_to_gold_events_per_sec": round(events / times["archive_to_gold"], 1),
            }
        )
    )


if __name__ == "__main__":
    main()
