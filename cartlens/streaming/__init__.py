"""Streams of user comments."""

from cartlens.streaming.archive import archive_comments
from cartlens.streaming.compaction import compact_archive, read_compacted
from cartlens.streaming.points import jdbc_points, ledger_points, parquet_points, stream_brand_points
from cartlens.streaming.totals import fold_live_total, live_total

__all__ = [
    "archive_comments",
    "compact_archive",
    "fold_live_total",
    "jdbc_points",
    "ledger_points",
    "live_total",
    "parquet_points",
    "read_compacted",
    "stream_brand_points",
]
