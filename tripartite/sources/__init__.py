"""Readers and writers: raw feeds, truth log, layouts by key, fact table, snapshot history."""

from tripartite.sources.files import (
    read_raw_csv,
    read_raw_sources,
    read_truth,
    register_views,
    write_csv,
    write_json,
)
from tripartite.sources.publish import PublishConflict, publish_table, read_table
from tripartite.sources.scratch import drop_folder, shared_dir, workspace, write_all, write_through
from tripartite.sources.tables import (
    captured_dates,
    correct_snapshot,
    delete_insert,
    not_captured,
    read_fact,
    read_snapshot,
    snapshot_breaks,
    snapshot_rows,
    write_fact,
)

__all__ = [
    "PublishConflict",
    "captured_dates",
    "correct_snapshot",
    "delete_insert",
    "drop_folder",
    "not_captured",
    "publish_table",
    "read_fact",
    "read_raw_csv",
    "read_raw_sources",
    "read_snapshot",
    "read_table",
    "read_truth",
    "register_views",
    "shared_dir",
    "snapshot_breaks",
    "snapshot_rows",
    "workspace",
    "write_all",
    "write_csv",
    "write_fact",
    "write_json",
    "write_through",
]
