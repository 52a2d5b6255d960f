"""Writers: versioned series store, single-series CSV, window export and forecast text."""

from hydroflow.sinks.series import (
    compact,
    count_series,
    export_csv,
    export_summary,
    export_window,
    export_windows,
    read_series,
    read_window_lines,
    render_forecast,
    series_ranges,
    series_versions,
    vacuum,
    write_series,
)

__all__ = [
    "compact",
    "count_series",
    "export_csv",
    "export_summary",
    "export_window",
    "export_windows",
    "read_series",
    "read_window_lines",
    "render_forecast",
    "series_ranges",
    "series_versions",
    "vacuum",
    "write_series",
]
