"""Row-level rules: derived columns, labels and predicates, all built from Spark SQL functions."""

from varloom.functions.columns import *  # noqa: F401,F403
from varloom.functions.predicates import *  # noqa: F401,F403
