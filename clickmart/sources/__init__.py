from clickmart.sources.codec import (
    accepted_events,
    decode_events,
    encode_events,
    judge_messages,
    rejected_messages,
    valid_events,
)
from clickmart.sources.files import read_events_csv, read_lake, read_lake_glob
from clickmart.sources.kafka import kafka_options, read_event_stream
from clickmart.sources.tables import (
    copy_table,
    describe_tables,
    ensure_table,
    migrate_events,
    migrate_if_any,
    migrate_profiles,
    read_columns,
    read_jdbc,
)

__all__ = [
    "accepted_events",
    "copy_table",
    "decode_events",
    "describe_tables",
    "encode_events",
    "ensure_table",
    "judge_messages",
    "kafka_options",
    "migrate_events",
    "migrate_if_any",
    "migrate_profiles",
    "read_columns",
    "read_event_stream",
    "read_events_csv",
    "read_jdbc",
    "read_lake",
    "read_lake_glob",
    "rejected_messages",
    "valid_events",
]
