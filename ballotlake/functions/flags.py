"""Flag and code normalisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def yes_flag(c, yes: str = "Y") -> Column:
    """``true`` only for exactly ``yes``; null and anything else -> false."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col == F.lit(yes), F.lit(False))


def code_map(c, mapping: Mapping[str, str], default: str | None = "") -> Column:
    """Map codes through a small literal dictionary, ``default`` otherwise
    (``None`` keeps unmapped codes as they are)."""
    col = F.col(c) if isinstance(c, str) else c
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    other = col if default is None else F.lit(default)
    return other if out is None else out.otherwise(other)
