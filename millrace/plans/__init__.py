"""Plan shapes that stay balanced when one key holds a large share of all rows."""

from millrace.plans.joins import broadcastable, lookup_join
from millrace.plans.running import Run, Splits, find_splits, numbered, rolling, running, top_n

__all__ = [
    "Run",
    "Splits",
    "broadcastable",
    "find_splits",
    "lookup_join",
    "numbered",
    "rolling",
    "running",
    "top_n",
]
