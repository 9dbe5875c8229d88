"""recordset: keyed record sets and their reports on Spark DataFrames.

Main entry points (all return lazy DataFrames unless noted):

    scan_set, scan_view, live_records, as_set       sources.store
    reader, writer                                  sources.api (chained options)
    infer_bin_types, infer_schema, typed_bins       sources.schema
    ingest_delimited, read_lines                    sources.ingest
    lookup_map, lookup_typed, lookup_wide,
    intersect_match                                 operators.lookup
    WriteSpec, merge, classify, write_set           operators.keyed_write
    write_bucketed, bucket_cut                      operators.bucketed_write
    latest_version, drop_old_versions               sources.layout
    where, index_bins                               sources.skipping
    ReportInputs, segment_report, report_lines,
    run_daily_report                                operators.report
    ReportChanges, update_counts, kept_report       operators.report_state
    write_stream_to_set                             streaming.sink
"""

from recordset.operators.bucketed_write import bucket_cut, write_bucketed
from recordset.operators.keyed_write import WriteConflict, WriteSpec, classify, merge, write_set
from recordset.operators.lookup import intersect_match, lookup_map, lookup_typed, lookup_wide
from recordset.operators.report import ReportInputs, report_lines, run_daily_report, segment_report
from recordset.operators.report_state import ReportChanges, kept_report, update_counts
from recordset.sources.api import reader, writer
from recordset.sources.ingest import ingest_delimited, read_lines
from recordset.sources.layout import drop_old_versions, latest_version
from recordset.sources.schema import infer_bin_types, infer_schema, typed_bins
from recordset.sources.skipping import index_bins, where
from recordset.sources.store import as_set, live_records, scan_set, scan_view
from recordset.streaming.sink import write_stream_to_set

__all__ = [
    "ReportChanges", "ReportInputs", "WriteConflict", "WriteSpec", "as_set", "bucket_cut", "classify", "drop_old_versions", "index_bins", "infer_bin_types",
    "infer_schema", "ingest_delimited", "intersect_match", "kept_report", "latest_version", "live_records", "lookup_map", "lookup_typed",
    "lookup_wide", "merge", "read_lines", "reader", "report_lines", "run_daily_report", "scan_set", "scan_view",
    "segment_report", "typed_bins", "update_counts", "where", "write_bucketed", "write_set", "write_stream_to_set", "writer",
]
