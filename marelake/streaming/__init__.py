"""Change topics under Structured Streaming."""

from .changes import (  # noqa: F401
    append_once,
    append_to_log,
    arriving_files,
    drop_replays,
    fan_out,
    maintain_state,
    run_available,
    span_folders,
    stream_files,
    topic_files,
    with_topic,
)
