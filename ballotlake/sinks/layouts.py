"""Tables laid out for the queries that read them: profiles and history by
voter for the joins (J5-J7), profiles by name for the lookup (P5, L1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None,
                   mode: str = "overwrite") -> DataFrame:
    """``df`` as a catalogue table in ``buckets`` files by a hash of ``key``, each
    sorted by it, and the table read back.

    Tables of the same number of buckets join and group by ``key`` without an
    exchange. One exchange comes before the write, so that each task writes one
    bucket; a bucket holds the rows of some hundred thousand voters or so, and a
    voter has a row per election, so no key is hot. Choose ``buckets`` for files
    of 128 to 256 MB. ``path``: an external table there (default: the warehouse).
    """
    w = (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).mode(mode))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df.sparkSession.table(table)


def write_for_lookup(df: DataFrame, path: str, keys: Sequence[str], files: int, bloom: Sequence[str] = (),
                     distinct: int = 100_000, row_group_bytes: int = 16 << 20) -> DataFrame:
    """``df`` as Parquet in ``files`` ranges of ``keys`` (sorted inside), with
    Bloom filters on the columns ``bloom`` (default: all keys), and read back.

    A lookup by the first key skips all row groups but those whose range holds
    the value; by other keys, those whose filter doesn't. A common first key is
    split by the next ones: end ``keys`` with the id. ``distinct`` is the number
    of values of a row group that its filters are sized for.
    """
    w = df.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.mode("overwrite")
    w = w.option("parquet.block.size", row_group_bytes)
    for c in bloom or keys:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", distinct)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)
