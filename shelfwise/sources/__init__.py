from .checkpoints import checkpoint, checkpoint_root
from .scans import conform, resolve_month_range, scan_partition, scope_filter, union_feeds
from .sinks import (
    affected_partitions,
    append_new,
    compact_partitions,
    guard_keys,
    layout,
    overwrite_one_partition,
    overwrite_partitions,
    replace_single_partition,
)

__all__ = [
    "affected_partitions", "append_new", "checkpoint", "checkpoint_root", "compact_partitions", "conform",
    "guard_keys", "layout", "overwrite_one_partition", "overwrite_partitions", "replace_single_partition",
    "resolve_month_range", "scan_partition", "scope_filter", "union_feeds",
]
