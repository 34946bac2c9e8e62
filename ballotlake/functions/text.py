"""String functions: case folding, canonical names, keyword classes,
feed label clean-up, composite keys."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results.
# County names whose upper-cased spelling starts with the key are rewritten
# to the value (ballot files spell some counties without the space).
COUNTY_PREFIXES: tuple[tuple[str, str], ...] = (
    ("BENHILL", "BEN HILL"),
    ("JEFFDAVIS", "JEFF DAVIS"),
)
# Candidate surname keywords -> party, tested in this order, first hit wins;
# anything else is "other".
CANDIDATE_PARTY_KEYWORDS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("republican", ("LOEFFLER", "TRUMP", "PERDUE", "KEMP", "WALKER")),
    ("democratic", ("BIDEN", "OSSOFF", "WARNOCK", "ABRAMS", "CLINTON")),
)
# Vote-mode group names of the newer JSON feed -> mode labels of the older feeds.
MODE_LABELS: tuple[tuple[str, str], ...] = (
    ("Absentee by Mail", "Absentee by Mail Votes"),
    ("Advanced Voting", "Advance Voting Votes"),
    ("Election Day", "Election Day Votes"),
    ("Provisional", "Provisional Votes"),
)
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze_upper(c) -> Column:
    """Upper case, runs of white space collapsed to one blank, trimmed."""
    return F.trim(F.regexp_replace(F.upper(_col(c)), r"\s+", " "))


def canonical_prefix(c, prefixes: Sequence[tuple[str, str]] = COUNTY_PREFIXES) -> Column:
    """``when(c.startswith(p), v)`` chain in the given order, else ``c``."""
    col = _col(c)
    out = None
    for prefix, value in prefixes:
        cond = col.startswith(prefix)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return col if out is None else out.otherwise(col)


def initcap_columns(df, cols: Iterable[str]):
    """Title-case several columns at once (one projection)."""
    return df.withColumns({c: F.initcap(F.col(c)) for c in cols})


def keyword_class(c, classes: Sequence[tuple[str, Sequence[str]]] = CANDIDATE_PARTY_KEYWORDS,
                  default: str = "other") -> Column:
    """Class of the first keyword list with a substring hit in ``upper(c)``.

    Built as one ``CASE WHEN upper(c) LIKE '%K1%' OR ...`` chain; no UDF.
    """
    up = F.upper(_col(c))
    out = None
    for label, words in classes:
        cond = None
        for w in words:
            hit = up.contains(w.upper())
            cond = hit if cond is None else (cond | hit)
        if cond is None:
            continue
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def party_from_code(code, name) -> Column:
    """Party code -> party class, with a fallback on the option's name.

    Codes are compared by prefix (``REP...`` -> republican, ``DEM...`` ->
    democratic), so ``REPUBLICAN`` is not mangled by a substring rewrite.
    An empty or missing code looks for ``Dem`` / ``Rep`` in the name, else
    ``unknown``; other codes are kept upper-cased.
    """
    up = F.upper(F.trim(_col(code)))
    nm = _col(name)
    by_name = (F.when(nm.contains("Dem"), "democratic")
               .when(nm.contains("Rep"), "republican")
               .otherwise("unknown"))
    return (F.when(up.isNull() | (up == ""), by_name)
            .when(up.startswith("REP"), "republican")
            .when(up.startswith("DEM"), "democratic")
            .otherwise(up))


def normalise_label(c, mapping: Sequence[tuple[str, str]] = MODE_LABELS) -> Column:
    """Exact-label lookup in a fixed mapping; unknown labels pass through."""
    col = _col(c)
    m = F.create_map(*[F.lit(x) for kv in mapping for x in kv])
    return F.coalesce(F.element_at(m, col), col) if mapping else col


def replace_first(c, old: str, new: str) -> Column:
    """Replace only the first occurrence of the literal ``old``."""
    return F.regexp_replace(_col(c), "^(.*?)" + re.escape(old),
                            "$1" + new.replace("\\", "\\\\").replace("$", "\\$"))


def strip_first(c, word: str) -> Column:
    """Remove the first occurrence of ``word`` (e.g. " County")."""
    return replace_first(c, word, "")


def contest_name(c, cut: str = "/", old: str = "Special Election", new: str = "Special") -> Column:
    """Text before the first ``cut``, then the first ``old`` -> ``new``."""
    return replace_first(F.substring_index(_col(c), cut, 1), old, new)


def first_token(c, suffix: str | Column = "", sep: str = " ") -> Column:
    """First ``sep``-separated token, optionally suffixed."""
    tok = F.substring_index(_col(c), sep, 1)
    suf = suffix if isinstance(suffix, Column) else F.lit(suffix)
    return F.concat(tok, suf)


def split_on(c, sep: str) -> Column:
    """Split on a literal delimiter (regex-escaped)."""
    return F.split(_col(c), re.escape(sep))


def underscore_spaces(c, every_whitespace: bool = True) -> Column:
    """All white space -> ``_`` (default) or only the first blank."""
    if every_whitespace:
        return F.regexp_replace(_col(c), r"\s", "_")
    return replace_first(c, " ", "_")


def composite_id(county, precinct, sep: str = "##") -> Column:
    """``COUNTY##PRECINCT`` upper-cased, or the county alone when the
    precinct is missing or empty."""
    cty, pre = F.upper(_col(county)), F.upper(_col(precinct))
    return F.when(pre.isNotNull() & (pre != ""), F.concat_ws(sep, cty, pre)).otherwise(cty)
