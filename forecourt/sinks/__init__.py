from forecourt.sinks.counting import counted, observed
from forecourt.sinks.files import append_bronze, overwrite_bronze, overwrite_silver
from forecourt.sinks.messages import (
    keyed_messages,
    move_in,
    routed_messages,
    send_files,
    send_kafka,
    send_keyed_files,
    write_aside,
)
from forecourt.sinks.tables import (
    DuplicateKeys,
    Merge,
    TypeClash,
    merge_into,
    publish_lasting_view,
    publish_view,
    save_table,
    upsert_table,
)

__all__ = [
    "DuplicateKeys",
    "append_bronze",
    "counted",
    "keyed_messages",
    "Merge",
    "merge_into",
    "move_in",
    "observed",
    "overwrite_bronze",
    "overwrite_silver",
    "publish_lasting_view",
    "publish_view",
    "routed_messages",
    "TypeClash",
    "save_table",
    "send_files",
    "send_kafka",
    "send_keyed_files",
    "upsert_table",
    "write_aside",
]
