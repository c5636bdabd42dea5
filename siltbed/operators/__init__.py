from siltbed.operators.committed import committed_read, disjoint_ranges
from siltbed.operators.mapping import (
    Mapper,
    accepted,
    csv_hour_mapper,
    get_mapper,
    register_mapper,
    rejected,
    row_mapper,
    table_mapper,
)
from siltbed.operators.metrics import (
    RolloverPolicy,
    batch_commit_metrics,
    read_rate,
    rollover_reason,
    route_sketch,
    routes_of_commits,
)
from siltbed.operators.offsets import (
    incremental_scan,
    ledger_heads,
    next_offset,
    offset_gaps,
    partition_bounds,
    repeated_messages,
    resolve_start,
    start_position,
)
from siltbed.operators.settle import settle
from siltbed.operators.small_side import small_side

__all__ = [
    "Mapper",
    "RolloverPolicy",
    "accepted",
    "batch_commit_metrics",
    "committed_read",
    "csv_hour_mapper",
    "disjoint_ranges",
    "get_mapper",
    "incremental_scan",
    "ledger_heads",
    "next_offset",
    "offset_gaps",
    "partition_bounds",
    "read_rate",
    "repeated_messages",
    "register_mapper",
    "rejected",
    "resolve_start",
    "rollover_reason",
    "route_sketch",
    "routes_of_commits",
    "row_mapper",
    "settle",
    "small_side",
    "start_position",
    "table_mapper",
]
