"""Writers (K1-K6) and caching helpers (K8)."""

from .layouts import write_bucketed, write_for_lookup  # noqa: F401
from .writers import (  # noqa: F401
    persisted, write_csv, write_json_lines, refresh_parquet, write_parquet, write_split_by,
)
