"""Written intermediate tables in the cluster's shared folder, and a
fixed-size membership filter.

Intermediate results are Parquet tables under ``spark.checkpoint.dir``: they
cut lineage, every executor can read them, and a lost executor costs only
its own unfinished tasks. The folder is read from the session; a folder of
our own is set only in local mode and where none is configured (tests). A
cluster without one is refused: its executors could not read each other's
local files.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="ballotlake-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path (not yet created) in the shared folder."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back (zstd Parquet)."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def written_once(df: DataFrame, name: str) -> DataFrame:
    """As ``written``; the shuffle files of the writing job go with its end."""
    spark = df.sparkSession
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(conf, None)
    spark.conf.set(conf, "true")
    try:
        return written(df, name)
    finally:
        if before is None:
            spark.conf.unset(conf)
        else:
            spark.conf.set(conf, before)


def remove(table: DataFrame) -> None:
    """Deletes the files of a table that ``written`` made and nothing reads
    any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit key of a row's id and text; nulls are values of their own."""
    i, t = F.col(doc_id), F.col(text)
    return F.xxhash64(i.isNull(), i, t.isNull(), t)


#: The filter has 2 ** FILTER_BITS bits in words of 64 bits, whatever the
#: input: 65,536 words of 16 bytes, 1 MB when broadcast.
FILTER_BITS = 22


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << FILTER_BITS))


def prefilter(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``key`` may be in ``wanted`` (one column, same name).

    A one-hash Bloom filter of fixed size: false positives are possible and
    an exact join must follow; there are no false negatives. It spares the
    shuffle of rows (whole texts) that the exact join would drop. Its size
    does not grow with the data, so it may always be broadcast; when it
    fills up it merely spares less. Null keys never pass. Let an inner join
    follow: Catalyst moves left-semi joins below the filter.
    """
    slot = _slot(F.col(key))
    words = (wanted.where(F.col(key).isNotNull())
             .select(F.shiftright(slot, 6).alias("_w"), F.pmod(slot, F.lit(64)).cast("int").alias("_b"))
             .groupBy("_w").agg(F.bit_or(F.expr("shiftleft(1L, _b)")).alias("_bits")))
    probe = (rows.where(F.col(key).isNotNull())
             .withColumn("_w", F.shiftright(_slot(F.col(key)), 6))
             .withColumn("_b", F.pmod(_slot(F.col(key)), F.lit(64)).cast("int")))
    return (probe.join(F.broadcast(words), "_w")
            .where(F.expr("(shiftright(_bits, _b) & 1L) = 1L")).drop("_w", "_b", "_bits"))
