"""Column functions. Everything here is a JVM-side expression; there is no UDF."""

from .naming import column_type, standardize_by_name  # noqa: F401
from .scalars import *  # noqa: F401,F403
from .standardize import *  # noqa: F401,F403
