"""All registered queries."""

from workbench import queries_learning, queries_songs, queries_stats, queries_tables  # noqa: F401
from workbench.registry import ORACLES, QUERIES  # noqa: F401
