"""Column-level (scalar) functions. All return ``Column`` expressions built
from ``pyspark.sql.functions`` so they stay inside whole-stage codegen."""

from .text import (  # noqa: F401
    canonical_prefix, composite_id, contest_name, first_token, initcap_columns,
    keyword_class, normalise_label, party_from_code, replace_first, squeeze_upper,
    split_on, strip_first, underscore_spaces, COUNTY_PREFIXES, CANDIDATE_PARTY_KEYWORDS,
    MODE_LABELS,
)
from .dates import days_from, parse_date  # noqa: F401
from .flags import yes_flag, code_map  # noqa: F401
from .similarity import similarity, token_sort, match_score  # noqa: F401
