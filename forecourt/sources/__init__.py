from forecourt.sources.catalog import (
    forget,
    load_mart,
    register_location,
    show_table,
    table_exists,
)
from forecourt.sources.files import (
    existing_schema,
    list_names,
    make_folder,
    move_new,
    path_exists,
    read_checked_csv,
    read_layer,
    read_raw_csv,
)

__all__ = [
    "existing_schema",
    "forget",
    "list_names",
    "load_mart",
    "make_folder",
    "move_new",
    "path_exists",
    "read_checked_csv",
    "read_layer",
    "read_raw_csv",
    "register_location",
    "show_table",
    "table_exists",
]
