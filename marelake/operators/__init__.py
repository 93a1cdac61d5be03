"""DataFrame building blocks."""

from .audit import bronze_audit, context_audit, gold_audit, silver_audit  # noqa: F401
from .compaction import compact_hour, compact_topics, compaction_plan, file_health, first_keys, latest_files  # noqa: F401
from .current import drop_deleted, latest_per_key  # noqa: F401
from .history import history_changes, load_history, version_history  # noqa: F401
from .joins import frequent_keys, lookup_join  # noqa: F401
from .measures import exact_median, monthly_measures, reaggregate  # noqa: F401
from .merge import (  # noqa: F401
    KeyedTable,
    append_new_columns,
    delete_tombstones,
    merge_into,
    supports_merge,
    sync_all_columns,
    upsert,
)
from .quality import Check, run_checks  # noqa: F401
from .watermark import footer_watermark, high_watermark, loaded_since, window_start_ms  # noqa: F401
