"""Readers for the source files: users and interactions as CSV, products as JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from basketry.schemas import INTERACTION_COLUMNS, PRODUCTS_RAW, USER_COLUMNS
from basketry.sources.json_array import read_json_array

USER_FILES = "*[uU][sS][eE][rR]*.csv"
INTERACTION_FILES = "*[tT][rR][aA][nN][sS][aA][cC][tT][iI][oO][nN]*.csv"

SOURCES = T.StructType([T.StructField("path", T.StringType()),
                        T.StructField("length", T.LongType())])


def list_sources(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Path and size of the matching files; an absent folder gives no rows."""
    try:
        return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
                .select("path", "length"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SOURCES)


def empty_sources(spark: SparkSession, folder: str, glob: str) -> list[str]:
    """Matching files without content, which Spark's readers do not list."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{glob}")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().toString() for s in fs.globStatus(pattern) or []
            if s.isFile() and s.getLen() == 0]


def missing_sources(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Expected file names that are absent or empty."""
    expected = spark.createDataFrame([(n,) for n in names], "name string")
    present = (list_sources(spark, folder, "*").where("length > 0")
               .select(F.substring_index("path", "/", -1).alias("name")))
    return expected.join(F.broadcast(present.join(F.broadcast(expected), "name", "left_semi")),
                         "name", "left_anti")


def require_sources(spark: SparkSession, folder: str, names: list[str]) -> None:
    missing = sorted(r["name"] for r in missing_sources(spark, folder, names).collect())
    if missing:
        raise FileNotFoundError(f"missing source files: {missing}")


def _with_lineage(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"),
                       F.col("_metadata.file_block_start").alias("block_start"),
                       F.monotonically_increasing_id().alias("row_seq"))


_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'  # outside quotes


def header_layouts(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """``(header, paths)``: the matching files by their first line, found in one job.

    A header is an array of names.  Only the first split of each file can hold its first line; of
    all other lines nothing but their place is kept.
    """
    lines = (spark.read.option("pathGlobFilter", glob).text(folder)
             .select("value", F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("seq")).where("block = 0"))
    first = lines.groupBy("path").agg(F.min_by("value", "seq").alias("line"))
    bare = F.regexp_replace(F.col("line"), "^\ufeff|\r$", "")
    quoted = F.regexp_replace(F.trim(F.col("name")), '^"(.*)"$', "$1")
    # The name comes as part of a URI, in which a plus stands for itself.
    path = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path")
    return (first.select(path, F.posexplode(F.split(bare, _COMMA)).alias("at", "name"))
            .groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", quoted.alias("name")))).alias("n"))
            .select("path", F.transform("n", lambda x: x["name"]).alias("header"))
            .groupBy("header").agg(F.array_sort(F.collect_list("path")).alias("paths")))


def read_csv_sources(spark: SparkSession, folder: str, glob: str,
                     required: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)`` of the matching CSV files.

    All columns are text; ``source_file``, ``block_start`` and ``row_seq`` give
    the order of rows.  Headers are read in one job; files with the same header share one scan,
    layouts are united by column name.  A file without the required columns, or an empty
    one, goes to the quarantine (path, missing_columns) instead of the rows.
    """
    refused = [(path, ",".join(required)) for path in empty_sources(spark, folder, glob)]
    parts = []
    # One row per layout, with the names of its files: all that passes through the driver here.
    try:
        layouts = sorted(header_layouts(spark, folder, glob).collect())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        layouts = []
    for header, paths in layouts:
        absent = [c for c in required if c not in header]
        if absent:
            refused += [(path, ",".join(absent)) for path in paths]
        else:
            schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
            parts.append(_with_lineage(spark.read.option("header", True).schema(schema).csv(paths)))
    quarantine = spark.createDataFrame(refused, "path string, missing_columns string")
    if not parts:
        text = ", ".join(f"`{c}` string" for c in required)
        empty = spark.createDataFrame(
            [], f"{text}, source_file string, block_start bigint, row_seq bigint")
        return empty, quarantine
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows, quarantine


FILE_ORDER = ["source_file", "block_start", "row_seq"]


def read_users(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All user files below a folder as text rows, and the quarantine."""
    return read_csv_sources(spark, folder, USER_FILES, USER_COLUMNS)


def read_interactions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All interaction files below a folder as text rows, and the quarantine."""
    return read_csv_sources(spark, folder, INTERACTION_FILES, INTERACTION_COLUMNS)


def read_products(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Products from JSON arrays, or from JSON lines; both are split over many tasks.

    ``source_file``, ``block_start`` and ``row_seq`` give the order of rows.  A malformed
    document fails the read.
    """
    if not lines:
        return read_json_array(spark, path, PRODUCTS_RAW)
    return _with_lineage(spark.read.schema(PRODUCTS_RAW).option("mode", "FAILFAST")
                         .option("encoding", "UTF-8").json(path))


def write_csv(df: DataFrame, path: str) -> None:
    """Export with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)
