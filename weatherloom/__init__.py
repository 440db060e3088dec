"""Station-record analytics on Spark: fixed-width climate archives to typed,
located, reshaped tables, and the usual queries on them."""

from .functions.layouts import (
    CORE_ELEMENTS,
    DAILY,
    DAILY_NETWORK_STATIONS,
    MONTHLY,
    MONTHLY_NETWORK_STATIONS,
    SlotLayout,
    StationLayout,
)
from .operators.consistency import (
    beyond_record,
    copied_months,
    lagged_ranges,
    mask_adjusted,
    record_extremes,
    spikes,
)
from .operators.corroboration import (
    daily_anomalies,
    duplicate_months,
    inconsistent_days,
    snow_in_warmth,
    uncorroborated,
)
from .operators.counts import reading_counts, value_count
from .operators.integrity import (
    Rule,
    check_integrity,
    daily_rules,
    first_of_month,
    in_range,
    monthly_rules,
    not_null,
    station_rules,
)
from .operators.joins import (
    complete_coordinates,
    exclude_files,
    inject_coords,
    sized_join,
    station_lookup,
)
from .operators.neighbours import nearest_stations
from .operators.outliers import (
    biweight_outliers,
    biweight_scores,
    climate_outliers,
    daily_climate,
    day_of_year,
    gap_outliers,
    spatial_outliers,
    value_gaps,
)
from .operators.profile import (
    examine_archives,
    examine_lines,
    examine_sample,
    explain_layout,
    file_statistics,
    first_file_lines,
    first_lines,
    first_matching_file,
    lines_of_first_file,
    profile_monthly,
    sample_lines,
)
from .operators.quality import (
    annual_series,
    average_from_extremes,
    best_source,
    duplicate_years,
    inconsistent_months,
    isolated_values,
    passed_quality,
)
from .operators.queries import (
    compare_quality,
    complete_rows,
    coordinate_coverage,
    count_by,
    monthly_mean,
    of_element,
    station_coordinates,
    station_points,
    within_bbox,
)
from .operators.reshape import (
    explode_values,
    to_daily_long,
    to_monthly_long,
    to_monthly_sparse,
    to_monthly_wide,
)
from .operators.series import (
    frequent_values,
    multiday_totals,
    spread_totals,
    streaks,
)
from .plans.etl import run_daily, run_monthly, run_monthly_archives, run_stations
from .session import build_session, shared_folder
from .sources.archives import archive_manifest, unpack_archives
from .sources.readings import (
    Scan,
    parse_daily,
    parse_monthly,
    rejected_files,
    rejected_lines,
    scan_daily,
    scan_monthly,
    unread_files,
    with_values,
)
from .sources.snapshots import (
    latest,
    read_daily,
    read_monthly,
    read_stations,
    snapshot_dates,
    write_daily,
    write_monthly,
    write_stations,
)
from .sources.stations import parse_stations, rejected_stations, scan_stations
from .sources.text import list_files, read_lines
from .streaming.landing import append_daily, append_with_rejects, landing_lines, stream_daily
