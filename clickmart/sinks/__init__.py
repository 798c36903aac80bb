from clickmart.sinks.buckets import read_buckets, upsert_buckets, write_buckets
from clickmart.sinks.items import (
    flat_items,
    put_items,
    recency_items,
    recommendation_items,
    segment_items,
    write_items_json,
)
from clickmart.sinks.messages import publish_events, publish_options
from clickmart.sinks.tables import (
    append_table,
    insert_overwrite,
    latest_version,
    overwrite_table,
    read_version,
    replace_stored_view,
    replace_view,
    serving_options,
    write_bucketed,
    write_csv,
    write_serving_table,
    write_version,
)

__all__ = [
    "append_table",
    "flat_items",
    "insert_overwrite",
    "latest_version",
    "overwrite_table",
    "publish_events",
    "publish_options",
    "put_items",
    "read_buckets",
    "read_version",
    "recency_items",
    "recommendation_items",
    "replace_stored_view",
    "replace_view",
    "segment_items",
    "serving_options",
    "upsert_buckets",
    "write_bucketed",
    "write_buckets",
    "write_csv",
    "write_items_json",
    "write_serving_table",
    "write_version",
]
