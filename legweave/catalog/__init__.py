"""All registered queries; importing this package fills the registry."""

from legweave.catalog import (  # noqa: F401
    aggregate_queries,
    filter_queries,
    gate_queries,
    job_queries,
    join_queries,
    model_queries,
    projection_queries,
    source_queries,
    stream_queries,
    window_queries,
)
from legweave.catalog.registry import REGISTRY  # noqa: F401
