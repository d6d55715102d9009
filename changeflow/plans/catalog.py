"""Importing this module registers every query."""

from changeflow.plans import (  # noqa: F401
    lob_queries,
    log_queries,
    schema_queries,
    sink_queries,
    snapshot_queries,
    state_queries,
    stream_queries,
    value_queries,
)
from changeflow.plans.registry import ORACLES, QUERIES  # noqa: F401
