"""Writers. Parallel by default: every task writes its own part file."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4 (K1 too): JSON lines, one part file per task."""
    df.write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """K2/K3: partitioned Parquet; ``mode="append"`` adds a new layout's
    rows after they were normalised to the common schema."""
    if partition_by:
        # A few files per value instead of one per task and value; AQE splits hot values.
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema of the Parquet dataset at ``path``, over all its layouts; None
    if nothing is there yet."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def check_contract(df: DataFrame, contract: StructType) -> None:
    """Raises ValueError that names each column of ``df`` that is missing, is not
    in the contract or has another type. Order and nullability don't count."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in contract.fields}
    drift = [f"missing column {c} {want[c]}" for c in want if c not in have]
    drift += [f"unexpected column {c} {have[c]}" for c in have if c not in want]
    drift += [f"column {c} is {have[c]}, not {want[c]}" for c in have if c in want and have[c] != want[c]]
    if drift:
        raise ValueError("schema drift: " + "; ".join(drift))


def refresh_parquet(df: DataFrame, path: str, partition_by: Sequence[str], contract: StructType | None = None) -> None:
    """K2/K3 that can be repeated: the partitions that ``df`` has rows of are
    replaced, all others stay, so a second run doubles nothing and a run of one
    election leaves the others. Partitions without rows in ``df`` are not emptied.

    The rows must meet the schema ``contract`` (by default that of the dataset
    as it is stored), or nothing is written.
    """
    contract = contract or stored_schema(df.sparkSession, path)
    if contract is not None:
        check_contract(df, contract)
        df = df.select(*contract.names)
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", quote_all: bool = True) -> None:
    """K5: CSV with header, every field quoted."""
    df.write.mode(mode).option("header", True).option("quoteAll", quote_all).csv(path)


def write_split_by(df: DataFrame, path: str, key: str, mode: str = "overwrite", fmt: str = "json") -> None:
    """K6: one output directory per key value (``key=VALUE/part-*``)."""
    df.hint("rebalance", key).write.mode(mode).partitionBy(key).format(fmt).save(path)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """K8: keep a shared intermediate for several actions, then release it
    (the reference's second, never-released caches are dropped)."""
    p = df.persist(level)
    try:
        yield p
    finally:
        p.unpersist()
