from docrel.sources.io import keyed_split_options, read_collection, read_table
from docrel.sources.sinks import (
    append_if_absent,
    read_csv,
    refresh,
    refresh_all,
    set_fields,
    write_csv,
    write_versioned,
)

__all__ = ["append_if_absent", "keyed_split_options", "read_collection", "read_csv",
           "read_table", "refresh", "refresh_all", "set_fields", "write_csv", "write_versioned"]
