"""Name similarity as a built-in expression (no Python UDF).

Score = round-half-up of ``100 * (1 - levenshtein(a, b) / max(len a, len b))``
on squeezed upper-case text, computed in integer arithmetic so every engine
gives the same integer 0..100. ``match_score`` also tries token-sorted text
("WARD 3 EAST" vs "EAST WARD 3") and keeps the better of the two.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import squeeze_upper


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def similarity(a, b) -> Column:
    a, b = _col(a), _col(b)
    n = F.greatest(F.length(a), F.length(b))
    d = F.levenshtein(a, b)
    # (200*(n-d) + n) div (2n) == floor(100*(n-d)/n + 1/2)
    return F.when(n == 0, F.lit(100)).otherwise(
        ((F.lit(200) * (n - d) + n) / (F.lit(2) * n)).cast("int")
    ).cast("int")


def token_sort(c) -> Column:
    return F.array_join(F.array_sort(F.split(_col(c), " ")), " ")


def match_score(a, b, token_sorted: bool = True) -> Column:
    """Best of plain and token-sorted similarity of squeezed upper text.
    Inputs should already be squeezed (``squeeze_upper``) when called in a
    join, so the normalisation happens once per row, not once per pair."""
    s = similarity(a, b)
    if token_sorted:
        s = F.greatest(s, similarity(token_sort(a), token_sort(b)))
    return s


__all__ = ["similarity", "token_sort", "match_score", "squeeze_upper"]
