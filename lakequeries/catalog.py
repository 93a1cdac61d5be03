"""All registered queries, in one place."""

from . import calendar_queries, change_queries, check_queries, file_queries, model_queries, stream_queries  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
