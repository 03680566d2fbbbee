"""Summaries of very large tables of keyed measurements, on PySpark."""

from .operators.apply import apply_per_batch, apply_per_chunk
from .operators.fold import Extremes, Fold, MeanVariance, fold_by_key, merge_fold, partial_fold
from .operators.gate import gate_stations
from .operators.keys import (
    distinct_stations,
    drop_stations,
    filter_station,
    join_on_station,
    keep_stations,
    keys_join_partials,
    lookup,
    union_distinct_stations,
    union_tables,
)
from .operators.lists import group_to_list, list_state, list_summary, merge_lists, number_chunks
from .operators.partial import chunk_summary, mean_of_means, merge_state, partial_state
from .operators.report import map_rows, report_lines, report_string, summary_map, write_report_lines
from .operators.summary import (
    round_mean_only,
    rounded,
    station_stats,
    station_summary,
    summarize,
    table_shape,
)
from .operators.stored import lookup_stored, open_result, row_of, store_result
from .plans.from_text import chunk_mean_report, station_report
from .schema import build_schema
from .sources.delimited import (
    parse_lines,
    preview,
    rejected_lines,
    scan_chunks,
    scan_delimited,
    scan_late_cast,
    scan_lines,
    write_chunk_files,
    write_lines,
)
from .sources.divided import divide_lines
from .sources.head import head_lines, preview_head
from .streaming.incremental import compact, incremental_stats, latest_stats, run_available
