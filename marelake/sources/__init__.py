"""Readers: raw change topics and file listings."""

from .changes import (  # noqa: F401
    CHANGE_META,
    conform_change,
    detect_layout,
    one_row,
    read_topic,
    scan_envelope,
    scan_flat,
    scan_mixed,
    union_topics,
)
from .files import day_folders, hour_folder_globs, list_files, merged_topics, partition_hour, topic_name  # noqa: F401
