"""DataFrame operators: numbering and halo windows, the feature chain, the split, keyed tables."""

from loadcast.operators.features import (
    densify_hours,
    final_features,
    join_raw,
    lag_profile,
    register_views,
    time_features,
    weather_features,
    window_features,
)
from loadcast.operators.kv import (
    export_latest,
    kv_cells,
    kv_compact,
    kv_current,
    kv_current_incremental,
    kv_from_cells,
    kv_write_batch,
    kv_write_by_day,
    range_scan,
)
from loadcast.operators.sequence import halo_windows, with_sequence
from loadcast.operators.split import assert_split_ordered, first_rows, split_bounds, time_folds, time_split

__all__ = [
    "assert_split_ordered", "densify_hours", "export_latest", "final_features", "first_rows", "halo_windows",
    "join_raw", "kv_cells", "kv_compact", "kv_current", "kv_current_incremental", "kv_from_cells",
    "kv_write_batch", "kv_write_by_day", "lag_profile", "range_scan", "register_views", "split_bounds",
    "time_features", "time_folds", "time_split", "weather_features", "window_features", "with_sequence",
]
