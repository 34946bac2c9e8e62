"""Records of large JSON documents, many tasks a file.

A feature collection or JSON array is one document, often one line, which
Spark's JSON reader gives to one task. Here it is read as text cut at ``}``,
which Spark splits by byte ranges, and the records are found by nesting
depth. A piece between two closing braces holds no escape that goes on in the
next piece, and what it does to the depth follows from two numbers: how many
quotes it has (is the next piece inside a string?) and how many opening braces
outside strings. Both are running totals over the pieces of a file: sums per
byte range, added up over ranges (one row each), then inside the ranges. Only
records that lie across pieces are put together, each by its own key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_RANGE = ["file", "range"]


def read_pieces(spark: SparkSession, paths) -> DataFrame:
    """``file, range, place, piece``: the text between closing braces; ``range``
    is the start of the byte range it was read in, ``place`` orders the pieces
    of a range."""
    df = spark.read.option("lineSep", "}").text(paths)
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
                     F.monotonically_increasing_id().alias("place"), F.col("value").alias("piece"))


def _before(pieces: DataFrame, value: str, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over all earlier pieces of the file.
    Ranges are added up first, then the pieces inside each."""
    sums = pieces.groupBy(*_RANGE).agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.select(*_RANGE, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*_RANGE).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (pieces.join(offset, _RANGE)
            .withColumn(name, F.col("__offset") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("__offset"))


def _outside(text: Column, starts_inside: Column) -> Column:
    """The parts of the text outside strings, as one text. Escaped characters
    are dropped first, so every quote left opens or closes a string."""
    bare = F.when(starts_inside, F.concat(F.lit('"'), text)).otherwise(text)
    return F.regexp_replace(bare, r'"[^"]*("|$)', '""')


def cut_records(pieces: DataFrame, depth: int) -> DataFrame:
    """``file, record, complete`` from ``file, range, place, piece``: the
    objects that lie ``depth`` objects deep (0: elements of an array, 1:
    features of a collection), as JSON text. ``complete`` is false for an
    object that the file's end cuts off."""
    bare = F.regexp_replace("piece", r"(?s)\\.", "")
    p = pieces.withColumn("__bare", bare).withColumn("__quotes", F.length("__bare") - F.length(F.replace("__bare", F.lit('"'))))
    p = _before(p, "__quotes", "__seen").withColumn("__inside", F.pmod("__seen", F.lit(2)) == 1)
    p = p.withColumn("__open", F.length(F.regexp_replace(_outside(F.col("__bare"), F.col("__inside")), r"[^{]", "")))
    # The brace after the piece closes an object unless a string goes on there.
    p = p.withColumn("__ends", F.pmod(F.col("__seen") + F.col("__quotes"), F.lit(2)) == 0)
    p = p.withColumn("__step", F.col("__open") - F.col("__ends").cast("int"))
    p = _before(p.drop("__bare", "__quotes", "__seen"), "__step", "__depth")
    begins = (F.col("__depth") <= depth) & (F.col("__depth") + F.col("__open") > depth)
    p = p.withColumn("__begins", begins.cast("int"))
    p = _before(p, "__begins", "__earlier").withColumn("__no", F.col("__earlier") + F.col("__begins"))
    # Inside an object of this depth, or at its start; text between records belongs to none.
    p = p.filter((F.col("__begins") == 1) | (F.col("__depth") > depth))
    closes = F.col("__ends") & (F.col("__depth") + F.col("__step") == depth)
    p = p.withColumns({"__text": F.when(F.col("__begins") == 1, _from_brace(F.lit(depth) - F.col("__depth"))).otherwise(F.col("piece")),
                       "__closes": closes})
    joined = p.groupBy("file", "__no").agg(
        F.array_sort(F.collect_list(F.struct("range", "place", "__text"))).alias("__parts"), F.bool_or("__closes").alias("complete"))
    return joined.select("file", F.concat(F.array_join(F.transform("__parts", lambda x: x["__text"]), "}"),
                                          F.when(F.col("complete"), "}").otherwise("")).alias("record"), "complete")


def _from_brace(skip: Column) -> Column:
    """The piece from its opening brace number ``skip`` + 1 outside strings on.
    A string that began earlier ends at the piece's first quote."""
    string = r'"(?:[^"\\]|\\.)*(?:"|$)'
    text = F.when(F.col("__inside"), F.concat(F.lit('"'), "piece")).otherwise(F.col("piece"))
    tokens = F.regexp_extract_all(text, F.lit(rf'(?s){string}|[^"{{]+|\{{'), F.lit(0))
    braces = F.transform(F.filter(F.transform(tokens, lambda x, i: F.struct((x == "{").alias("hit"), i.alias("i"))),
                                  lambda x: x["hit"]), lambda x: x["i"])
    return F.array_join(F.slice(tokens, F.get(braces, skip) + 1, F.size(tokens)), "")


def json_records(spark: SparkSession, paths, depth: int) -> DataFrame:
    """The objects of JSON documents at a depth, one per row: see :func:`cut_records`."""
    return cut_records(read_pieces(spark, paths), depth)
