"""Date parsing and day offsets."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def parse_date(c, fmt: str | None = "MM/dd/yyyy", dtype=None) -> Column:
    """Text -> date with ``try_to_date`` (unparsable text gives null instead
    of failing the job under ANSI). Date/timestamp input is cast."""
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)) or fmt is None:
        return F.to_date(col)
    return F.try_to_date(col, fmt)


def days_from(c, anchor) -> Column:
    """Signed whole days from ``anchor`` (a ``date``/ISO string) to ``c``."""
    if isinstance(anchor, (_dt.date, _dt.datetime)):
        anchor = anchor.isoformat()[:10]
    col = F.col(c) if isinstance(c, str) else c
    return F.datediff(col, F.to_date(F.lit(anchor)))
