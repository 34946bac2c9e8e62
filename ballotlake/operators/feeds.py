"""Flattening nested result feeds into T2 rows (C7): race, county, precinct,
candidate, party, mode, votes. Nested arrays are unrolled with
``explode``/``inline``/``posexplode`` inside one projection pipeline: a
feed document is one row, so no shuffle is needed until the caller
aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import (CANDIDATE_PARTY_KEYWORDS, MODE_LABELS, contest_name, keyword_class,
                              normalise_label, party_from_code, split_on)

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results.
# Contests kept from the feeds (substring match on the contest text).
CONTEST_PHRASES: tuple[str, ...] = ("US Senate", "President of the United States", "Governor")
UNDER_OVER_CANDIDATE = "Under/Over Votes"
UNDER_OVER_PARTY = "other"
UNDER_OVER_MODE = "Absentee by Mail Votes"
UNKNOWN_MODE = "Unknown"
TOTAL_LINE_ID = "-1"
# ---------------------------------------------------------------------------

T2 = ("race", "county", "precinct", "candidate", "party", "mode", "votes")


def contains_any(c, phrases: Sequence[str]) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    cond = None
    for p in phrases:
        hit = col.contains(p)
        cond = hit if cond is None else cond | hit
    return cond if cond is not None else F.lit(True)


def detail_or_total(modes: Column, total: Column, mode_field: str = "mode", votes_field: str = "votes",
                    unknown: str = UNKNOWN_MODE) -> Column:
    """The per-mode array, or, when its votes sum to 0 (or it is
    empty), a one-element array carrying ``total`` under mode ``unknown``."""
    s = F.aggregate(modes, F.lit(0).cast("long"), lambda a, m: a + F.coalesce(m[votes_field], F.lit(0)).cast("long"))
    fallback = F.array(F.struct(F.lit(unknown).alias(mode_field), total.cast("long").alias(votes_field)))
    return F.when(F.coalesce(s, F.lit(0)) == 0, fallback).otherwise(
        F.transform(modes, lambda m: F.struct(m[mode_field].alias(mode_field),
                                              m[votes_field].cast("long").alias(votes_field))))


def flatten_xml_feed(doc: DataFrame, phrases: Sequence[str] = CONTEST_PHRASES,
                     keywords=CANDIDATE_PARTY_KEYWORDS) -> tuple[DataFrame, DataFrame]:
    """T12 (one row per county document, attributes prefixed ``_``) ->
    ``(rows, rejects)``. A contest without choices or without its
    under/over block is rejected whole and reported; a choice without
    vote types is reported and skipped. Rows with votes <= 0 are dropped."""
    # explode_outer + a null filter: the same rows as explode, without the
    # inferred size(Contest) > 0 filter that would evaluate a computed
    # document column (e.g. from_xml over text) a second time.
    c = (doc.select(F.col("Region").alias("county"), F.explode_outer("Contest").alias("c"))
         .filter(F.col("c").isNotNull() & contains_any(F.col("c._text"), phrases))
         .withColumn("race", contest_name(F.col("c._text"))))
    no_choice = F.coalesce(F.size("c.Choice"), F.lit(-1)) <= 0
    no_under = F.coalesce(F.size("c.VoteType"), F.lit(-1)) <= 0
    good = c.filter(~(no_choice | no_under))
    # One pass for the rejects as well: what is wrong with the contest, or else with each of its choices.
    none = F.lit(None).cast("string")

    def wrong(candidate: Column, reason: str) -> Column:
        return F.struct(candidate.alias("candidate"), F.lit(reason).alias("reason"))

    bad_choices = F.transform(F.filter("c.Choice", lambda x: F.coalesce(F.size(x["VoteType"]), F.lit(-1)) <= 0),
                              lambda x: wrong(x["_text"], "no vote types"))
    problems = (F.when(no_choice, F.array(wrong(none, "no choices"))).when(no_under, F.array(wrong(none, "no under/over votes")))
                .otherwise(bad_choices))
    rejects = (c.select("county", "race", F.explode_outer(problems).alias("p")).filter(F.col("p").isNotNull())
               .select("county", "race", "p.*"))
    # One pass over the documents: every (candidate, mode, precinct list) of
    # the choices and of the under/over block goes into one array per
    # contest, exploded once (no union of two re-reads of the source).
    per_choice = F.flatten(F.transform(F.col("c.Choice"), lambda chx: F.transform(
        F.coalesce(chx["VoteType"], F.array().cast("array<struct<_name:string,Precinct:array<struct<_name:string,_votes:long>>>>")),
        lambda vt: F.struct(chx["_text"].alias("candidate"), keyword_class(chx["_text"], keywords).alias("party"),
                            vt["_name"].alias("mode"), vt["Precinct"].alias("P")))))
    under = F.transform(F.col("c.VoteType"), lambda vt: F.struct(
        F.lit(UNDER_OVER_CANDIDATE).alias("candidate"), F.lit(UNDER_OVER_PARTY).alias("party"),
        F.lit(UNDER_OVER_MODE).alias("mode"), vt["Precinct"].alias("P")))
    rows = (good.select("county", "race", F.explode_outer(F.concat(per_choice, under)).alias("g"))
            .select("county", "race", "g.candidate", "g.party", "g.mode", F.explode_outer("g.P").alias("p"))
            .select("race", "county", F.col("p._name").alias("precinct"), "candidate", "party", "mode",
                    F.col("p._votes").cast("long").alias("votes"))
            .filter(F.col("votes") > 0))
    return rows, rejects


def flatten_feed_a(summary: DataFrame, modes: DataFrame, keys: Sequence[str] = ("county",),
                   phrases: Sequence[str] = CONTEST_PHRASES, keywords=CANDIDATE_PARTY_KEYWORDS,
                   mode_col: str = "mode", mode_labels: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """``summary`` rows ``county, K, C, CH[]`` (contest id, text, candidate
    names) and ``modes`` rows ``county, mode, Contests[]{A, C[], V[][]}`` of any
    number of counties. Counties use the same contest ids for different
    contests, so both sides meet on ``keys`` (columns that say whose feed it is,
    ``county`` among them) and the contest id.

    Contest ids and vote lists are parallel arrays: zipped, exploded with
    their positions, then the candidate is ``CH[position]``. Contests not
    in the (filtered) summary are skipped by the inner join; the summary
    holds one row per contest and is left to AQE, which broadcasts it when
    its measured size is small. The hidden total line
    (``A = '-1'``) is dropped. ``mode_labels`` optionally maps mode names
    to one vocabulary shared with the other feeds (e.g. ``("Advanced Voting
    Votes", "Advance Voting Votes")``); by default they are kept as named.
    """
    keys = list(keys)
    s = (summary.filter(contains_any(F.col("C"), phrases))
         .select(*keys, F.col("K").cast("string").alias("contest_id"), contest_name(F.col("C")).alias("race"),
                 F.col("CH").alias("choices")))
    mode = normalise_label(F.col(mode_col), mode_labels) if mode_labels else F.col(mode_col)
    p = (modes.select(*keys, mode.alias("mode"), F.explode_outer("Contests").alias("p"))
         .filter(F.col("p").isNotNull() & (F.col("p.A").cast("string") != F.lit(TOTAL_LINE_ID)))
         .select(*keys, "mode", F.col("p.A").cast("string").alias("precinct"),
                 F.explode_outer(F.arrays_zip(F.col("p.C").alias("cid"), F.col("p.V").alias("votes"))).alias("z"))
         .filter(F.col("z").isNotNull())
         .select(*keys, "mode", "precinct", F.col("z.cid").cast("string").alias("contest_id"),
                 F.posexplode_outer("z.votes").alias("pos", "votes"))
         .filter(F.col("pos").isNotNull()))
    j = p.join(s, [*keys, "contest_id"], "inner")
    cand = F.element_at(F.col("choices"), F.col("pos") + 1)
    return (j.select("race", "county", "precinct", cand.alias("candidate"),
                     keyword_class(cand, keywords).alias("party"), "mode", F.col("votes").cast("long").alias("votes"))
            .filter(F.col("votes") > 0))


def _text0(c: Column) -> Column:
    """``x.name[0].text`` of the newer feed's localised names."""
    return F.element_at(c, 1)["text"]


def flatten_feed_b(doc: DataFrame, mode_labels=MODE_LABELS) -> DataFrame:
    """Rows ``race, county, breakdownResults[]{precinct.name[].text, ballotOptions[]{
    name[].text, party.name[].text, voteCount, groupResults[]{groupName[].
    text, voteCount}}}`` -> T2 rows, with per-mode detail or, when the modes
    sum to 0, the option's total as mode ``Unknown``; votes > 0 only."""
    # *_outer generators + null filters: same rows, but no inferred
    # size(...) > 0 filter re-evaluating a computed document column.
    b = (doc.select("race", "county", F.explode_outer("breakdownResults").alias("b"))
         .filter(F.col("b").isNotNull())
         .select("race", "county", _text0(F.col("b.precinct.name")).alias("precinct"),
                 F.explode_outer("b.ballotOptions").alias("o"))
         .filter(F.col("o").isNotNull()))
    cand = _text0(F.col("o.name"))
    modes = F.transform(F.coalesce(F.col("o.groupResults"), F.array()), lambda g: F.struct(
        normalise_label(_text0(g["groupName"]), mode_labels).alias("mode"), g["voteCount"].alias("votes")))
    o = b.select("race", "county", "precinct", cand.alias("candidate"),
                 party_from_code(F.coalesce(_text0(F.col("o.party.name")), F.lit("")), cand).alias("party"),
                 F.inline_outer(detail_or_total(modes, F.col("o.voteCount"))))
    return o.select(*T2).filter(F.col("votes") > 0)


def first_per_group(df: DataFrame, group: Sequence[str], order_col: str, cond: Column | None = None) -> DataFrame:
    """Per group, the row with the smallest ``order_col`` among
    rows satisfying ``cond`` (``min(struct)``: partial aggregation, no
    per-group sort)."""
    src = df.filter(cond) if cond is not None else df
    rest = [c for c in df.columns if c not in group and c != order_col]
    best = F.min(F.struct(F.col(order_col), *[F.col(c) for c in rest])).alias("__b")
    return src.groupBy(*group).agg(best).select(*group, "__b.*")


def explode_parallel(df: DataFrame, cols: Sequence[str], sep: str = "|", keep: Sequence[str] = (),
                     pos_col: str = "pos") -> DataFrame:
    """Delimited strings that are parallel lists (``"a|b"``,
    ``"1|2"``) -> one row per position with the i-th item of each list.
    Lists of unequal length are padded with nulls (``arrays_zip``)."""
    zipped = F.arrays_zip(*[split_on(c, sep).alias(c) for c in cols])
    return (df.select(*keep, F.posexplode_outer(zipped).alias(pos_col, "__z"))
            .filter(F.col(pos_col).isNotNull())
            .select(*keep, pos_col, *[F.col(f"__z.{c}").alias(c) for c in cols]))


flatten_xml = flatten_xml_feed
flatten_json_a = flatten_feed_a
flatten_json_b = flatten_feed_b
