from eventlake.operators.compaction import compact, file_stats
from eventlake.operators.dedupe import first_per_key
from eventlake.operators.incremental import (
    affected_dates,
    high_water_mark,
    newer_than,
    on_dates,
    rows_after,
)
from eventlake.operators.merge import (
    append,
    create,
    insert_only,
    merge_insert_only,
    merge_upsert,
    overwrite,
    overwrite_partitions,
    replace_partitions,
    upsert,
)
from eventlake.operators.quality import (
    Check,
    DataQualityError,
    NotNull,
    RequiredColumns,
    Unique,
    audit,
    enforce,
    enforce_all,
)
from eventlake.operators.ranking import first_n, top_k
from eventlake.operators.routing import expected_messages, keyed_messages, route
from eventlake.operators.staging import stage

__all__ = [
    "Check",
    "DataQualityError",
    "NotNull",
    "RequiredColumns",
    "Unique",
    "affected_dates",
    "append",
    "audit",
    "compact",
    "create",
    "enforce",
    "enforce_all",
    "expected_messages",
    "file_stats",
    "first_n",
    "first_per_key",
    "high_water_mark",
    "insert_only",
    "keyed_messages",
    "merge_insert_only",
    "merge_upsert",
    "newer_than",
    "on_dates",
    "overwrite",
    "overwrite_partitions",
    "replace_partitions",
    "route",
    "rows_after",
    "stage",
    "top_k",
    "upsert",
]
