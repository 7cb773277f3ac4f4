"""Where tables come from and where reports go."""

from parcelledger.sources.catalog import append_load_named, refresh_named
from parcelledger.sources.scratch import scratch_dir, use_checkpoint_dir
from parcelledger.sources.sinks import (
    append_load,
    export_csv,
    replace_table,
    write_clustered,
)
from parcelledger.sources.tables import Tables
from parcelledger.sources.versions import create_version_table, read_version

__all__ = [
    "Tables",
    "append_load",
    "append_load_named",
    "create_version_table",
    "export_csv",
    "read_version",
    "refresh_named",
    "replace_table",
    "scratch_dir",
    "use_checkpoint_dir",
    "write_clustered",
]
