"""Readers for the landed inputs (S1-S13). All are lazy ``spark.read``
calls with declared schemas where the layout is known, so no inference
pass is run and filters/projections reach the scan."""

from .csv import (  # noqa: F401
    HISTORY_NEW_SCHEMA, HISTORY_OLD_SCHEMA, PROFILE_SCHEMA, RESULTS_SCHEMA,
    read_ballots, read_history_new, read_history_old, read_lookup, read_profile_sources, read_results,
)
from .fixed_width import HISTORY_WIDTHS, parse_fixed_width, read_fixed_width  # noqa: F401
from .feeds import (read_ballot_items, read_feed_a_modes, read_feed_a_summary, read_feed_b,  # noqa: F401
                    read_xml_feed)  # noqa: F401
from .geojson import parse_features, read_features, read_feature_lines, read_large_features  # noqa: F401
from .parquet import read_large_json_array, read_parquet, read_json_array  # noqa: F401
