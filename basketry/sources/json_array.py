"""A large JSON array read by many tasks.

Spark reads an array document as a whole, one task a file.  Here the file is split like text, at
its closing braces, and what a piece lacks comes from the pieces before it: whether it begins
inside a string (the parity of the quotes so far), how deep it is nested, and the number of its
record.  All three are prefix sums, taken inside each split and then over the splits of a file, so
no task sees a whole file.  The pieces of a record are put together again and parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from basketry.session import materialise

_ESCAPE = r"(?s)\\."
_SPACE = r"[ \t\r\n]*"


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The file between its closing braces, with what each piece adds to quotes and depth."""
    lines = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value")
    parts = F.split(F.regexp_replace("value", _ESCAPE, ""), '"')

    def deeper(parity: int) -> Column:
        """What a piece adds to the depth if its parts of this parity lie outside strings."""
        outside = F.array_join(F.filter(parts, lambda _, i: i % 2 == parity), " ")
        return _count(outside, "{") + _count(outside, "[") - _count(outside, "]")

    return materialise(lines.select(
        "file", "block", "seq", "value", (F.size(parts) - 1).cast("bigint").alias("quotes"),
        deeper(0).cast("bigint").alias("deeper_outside"),
        deeper(1).cast("bigint").alias("deeper_inside")), "json-pieces")


def _with_total_before(rows: DataFrame, value: str, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the pieces before this one in its file."""
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(
        Window.unboundedPreceding, -1)  # no more than a split of the file
    over = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (rows.groupBy("file", "block").agg(F.sum(value).alias("t"))
              .select("file", "block", F.coalesce(F.sum("t").over(over), F.lit(0)).alias("earlier")))
    return (rows.withColumn("within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(blocks, ["file", "block"])
            .withColumn(name, F.col("earlier") + F.col("within")).drop("earlier", "within"))


def _failed(message: str, text: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"malformed JSON array, {message}: "), F.substring(text, 1, 80)))


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, block_start, row_seq, text``: the objects of the arrays, unparsed."""
    pieces = _pieces(spark, path)
    last = pieces.groupBy("file").agg(F.max(F.struct("block", "seq")).alias("end"))
    pieces = pieces.join(last, "file").withColumn(
        "closed", F.struct("block", "seq") < F.col("end")).drop("end")
    quoted = _with_total_before(pieces, "quotes", "quotes_before")
    begins_inside = F.col("quotes_before") % 2 == 1
    ends_outside = (F.col("quotes_before") + F.col("quotes")) % 2 == 0
    closes = F.col("closed") & ends_outside  # its brace is no character of a string
    nested = materialise(quoted.select(
        "file", "block", "seq", "value", "closed", closes.alias("closes"),
        (F.when(begins_inside, F.col("deeper_inside")).otherwise(F.col("deeper_outside"))
         - closes.cast("bigint")).alias("deeper")), "json-depths")
    deep = _with_total_before(nested, "deeper", "depth_before")
    ends = F.col("closes") & (F.col("depth_before") + F.col("deeper") == 1)
    marked = materialise(deep.withColumn("ends", ends.cast("bigint")).drop("depth_before"), "json-ends")
    numbered = _with_total_before(marked, "ends", "record")
    piece = F.concat("value", F.when(F.col("closed"), F.lit("}")).otherwise(F.lit("")))
    records = numbered.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", piece.alias("text")))).alias("p"),
        F.max("ends").alias("whole"))
    text = F.array_join(F.transform("p", lambda x: x["text"]), "")
    first = F.col("record") == 0
    lead = F.when(first, F.lit(rf"^﻿?{_SPACE}\[{_SPACE}")).otherwise(F.lit(f"^{_SPACE},{_SPACE}"))
    tail = F.when(first, F.lit(rf"^﻿?{_SPACE}\[{_SPACE}\]{_SPACE}$")).otherwise(
        F.lit(rf"^{_SPACE}\]{_SPACE}$"))
    body = (F.when((F.col("whole") == 1) & F.regexp_like(text, lead), F.regexp_replace(text, lead, F.lit("")))
            .when(F.col("whole") == 1, _failed("no separator before", text))
            .when(F.regexp_like(text, tail), F.lit(None).cast("string"))
            .otherwise(_failed("unfinished at", text)))
    return (records.select(F.col("file").alias("source_file"), F.col("p")[0]["block"].alias("block_start"),
                           F.col("p")[0]["seq"].alias("row_seq"), body.alias("text"))
            .where("text is not null"))


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of the objects in array documents; a malformed document fails the read.

    ``source_file``, ``block_start`` and ``row_seq`` give the order of rows.  Elements that are no
    objects fail as well.
    """
    parsed = F.from_json("text", schema, {"mode": "FAILFAST"})
    return (record_texts(spark, path).withColumn("row", parsed)
            .select("row.*", "source_file", "block_start", "row_seq"))
