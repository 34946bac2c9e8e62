"""Landed feeds -> flat results table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import strip_first
from ..operators.feeds import first_per_group, flatten_feed_a, flatten_feed_b, flatten_xml_feed
from ..sources.feeds import (read_ballot_items, read_feed_a_modes, read_feed_a_summary, read_feed_b,
                             read_xml_feed)


def results_from_xml(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """All county XML documents in one read -> (rows, rejects)."""
    return flatten_xml_feed(read_xml_feed(spark, paths))


FEED_A_KEYS = ["county", "countyElectionId", "version"]


def current_feeds(manifest: DataFrame, **feeds: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The rows of each feed that the ``manifest`` names (its columns are the
    key), and a report ``<key>, problem``: a manifest entry without rows in a
    feed (``no <feed>``), rows in a feed that no entry names (``<feed> not in
    manifest``: older versions, counties that left). A manifest entry that
    occurs twice counts once."""
    keys = manifest.columns
    wanted = manifest.distinct()
    current, problems = [], []
    for name, feed in feeds.items():
        current.append(feed.join(wanted, keys, "left_semi"))
        # Files to entries is many to one: keys are reduced before they are compared.
        there = feed.select(*keys).distinct()
        problems.append(wanted.join(there, keys, "left_anti").withColumn("problem", F.lit(f"no {name}")))
        problems.append(there.join(wanted, keys, "left_anti").withColumn("problem", F.lit(f"{name} not in manifest")))
    return current, reduce(DataFrame.unionByName, problems)


def feed_a_results(summary: DataFrame, modes: DataFrame, manifest: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Feed A of all counties of the manifest (``county, countyElectionId,
    version``) -> (rows, report of :func:`current_feeds`)."""
    (s, m), report = current_feeds(manifest.select(*FEED_A_KEYS), summary=summary, modes=modes)
    return flatten_feed_a(s, m, FEED_A_KEYS, **options), report


def results_from_feed_a(spark: SparkSession, root: str, manifest: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """All counties below ``root`` in one read each of summaries and modes."""
    return feed_a_results(read_feed_a_summary(spark, root), read_feed_a_modes(spark, root), manifest, **options)


def locality_records(doc: DataFrame) -> DataFrame:
    """S12, newest layout: ``childLocalities[]{shortName, name[]{text}}`` -> one
    row per locality with its county name (without the word County)."""
    return (doc.select(F.explode("childLocalities").alias("l"))
            .select(F.col("l.shortName").alias("locality"),
                    strip_first(F.element_at("l.name", 1)["text"], " County").alias("county")))


def ballot_items(doc: DataFrame, keys: Sequence[str] = ("locality",)) -> DataFrame:
    """Ballot-item listings (``data[]{id, name[]{text}}`` per locality) -> one
    row per item with its list position."""
    return (doc.select(*keys, F.posexplode("data").alias("pos", "item"))
            .select(*keys, "pos", F.col("item.id").cast("string").alias("contestId"),
                    F.element_at(F.col("item.name"), 1)["text"].alias("name")))


def relevant_contests(items: DataFrame, phrases: Sequence[str], keys: Sequence[str] = ("locality",),
                      pos_col: str = "pos", name_col: str = "name") -> DataFrame:
    """Per locality and phrase (``race``), the first ballot item (lowest
    list position) whose name contains the phrase -- the contest whose results
    are then read."""
    hits = F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(F.col(name_col), p))
    return first_per_group(items.withColumn("race", F.explode(hits)), [*keys, "race"], pos_col)


def feed_b_results(docs: DataFrame, items: DataFrame, localities: DataFrame, phrases: Sequence[str]
                   ) -> tuple[DataFrame, DataFrame]:
    """Feed B of all localities -> (rows, report ``locality, race, problem``).

    Every locality of ``localities`` (``locality, county``) has its own contest
    ids; the contest of a phrase is looked up in its own list, and its document
    by (locality, contest id). Reported are contests without a document and
    localities without a contest for a phrase. Documents of other contests
    are no problem."""
    races = localities.select("locality", "county").distinct().withColumn(
        "race", F.explode(F.array(*[F.lit(p) for p in phrases])))
    first = relevant_contests(items, phrases).select("locality", "race", "contestId")
    wanted = races.join(first, ["locality", "race"], "left")
    there = docs.select("locality", "contestId").distinct().withColumn("found", F.lit(True))
    report = (wanted.join(there, ["locality", "contestId"], "left").filter("found is null")
              .select("locality", "race", F.when(F.col("contestId").isNull(), "no contest").otherwise("no document")
                      .alias("problem")))
    named = docs.join(wanted.filter("contestId is not null"), ["locality", "contestId"])
    return flatten_feed_b(named), report


def results_from_feed_b(spark: SparkSession, root: str, localities: DataFrame, phrases: Sequence[str]
                        ) -> tuple[DataFrame, DataFrame]:
    """All localities below ``root`` in one read each of lists and documents."""
    items = ballot_items(read_ballot_items(spark, root))
    return feed_b_results(read_feed_b(spark, root), items, localities, phrases)


def manifest_records(doc: DataFrame, col: str = "participatingcounties") -> DataFrame:
    """S12, current layout: an array of ``"county|electionId|version|..."``
    strings -> one row per county with its first three fields."""
    rec = F.split(F.col("r"), r"\|")
    return (doc.select(F.explode(col).alias("r"))
            .select(F.element_at(rec, 1).alias("county"), F.element_at(rec, 2).alias("countyElectionId"),
                    F.element_at(rec, 3).alias("version")))


def manifest_parallel(doc: DataFrame, ids: str = "Eid", names: str = "P") -> DataFrame:
    """S12, older layout: parallel arrays of county election ids and county
    names -> one row per position; the name's first blank becomes ``_``
    (the form used in the feed's paths)."""
    from ..functions.text import underscore_spaces
    z = F.arrays_zip(F.col(ids).alias("eid"), F.col(names).alias("name"))
    return (doc.select(F.posexplode(z).alias("pos", "z"))
            .select("pos", underscore_spaces(F.col("z.name"), every_whitespace=False).alias("county"),
                    F.col("z.eid").cast("string").alias("countyElectionId")))
