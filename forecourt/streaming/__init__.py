from forecourt.streaming.bronze import (
    StreamTimeout,
    drain_batches,
    drain_to_bronze,
    parse_messages,
    read_keyed_files,
    read_message_files,
    read_topic,
    start_bronze,
    unreadable,
    usable,
    wait,
)

__all__ = [
    "StreamTimeout",
    "drain_batches",
    "drain_to_bronze",
    "parse_messages",
    "read_keyed_files",
    "read_message_files",
    "read_topic",
    "start_bronze",
    "unreadable",
    "usable",
    "wait",
]
