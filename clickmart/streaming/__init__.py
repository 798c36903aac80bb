from clickmart.streaming.features import (
    compact_features,
    read_features,
    start_feature_refresh,
)
from clickmart.streaming.ingest import start_ingest, start_rejects

__all__ = ["compact_features", "read_features", "start_feature_refresh", "start_ingest", "start_rejects"]
