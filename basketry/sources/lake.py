"""The dated lake: ``<base>/<layer>/<source>/dt=YYYY-MM-DD``."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from basketry.operators.profiling import content_sum

FORMATS = ("parquet", "csv", "json")


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path, from one file-system listing."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    return [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote the folder came to its end."""
    fs, marker = _file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def _check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt}")
    return fmt


@dataclass(frozen=True)
class Lake:
    """Reads and writes dated snapshots.  The run date is always given."""

    spark: SparkSession
    base: str

    def path(self, layer: str, source: str, dt: str | None = None) -> str:
        root = f"{self.base.rstrip('/')}/{layer}/{source}"
        return root if dt is None else f"{root}/dt={dt}"

    # Writing

    def save(self, df: DataFrame, layer: str, source: str, dt: str,
             fmt: str = "parquet") -> DataFrame:
        """Replace the snapshot of one date and read it back."""
        writer = df.write.mode("overwrite").format(_check_format(fmt))
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(self.path(layer, source, dt))
        if fmt == "parquet":
            self._record(df.schema, layer, source, dt)
        return self.snapshot(layer, source, dt, fmt, df.schema)

    def save_by_date(self, df: DataFrame, layer: str, source: str, date_column: str) -> None:
        """Replace the snapshots of all dates that occur in the rows.

        The rebalance hint lets the runtime gather small dates into one file
        and split a large date over several tasks.
        """
        dated = df.withColumn("dt", F.date_format(F.col(date_column).cast("date"), "yyyy-MM-dd"))
        (dated.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt")
         .option("partitionOverwriteMode", "dynamic").parquet(self.path(layer, source)))
        # Dates are moved into place one by one when the job is done; Spark leaves no marker then.
        fs, marker = _file_system(self.spark, f"{self.path(layer, source)}/_SUCCESS")
        fs.create(marker, True).close()
        self._record(df.schema, layer, source, "0000-00-00")

    def _record(self, schema: StructType, layer: str, source: str, dt: str) -> None:
        """Note a schema with the first date that has it; a folder per change, not per date."""
        folder = f"{self.base.rstrip('/')}/_schemas/{layer}/{source}"
        text = json.dumps([[f.name, f.dataType.simpleString()] for f in schema.fields if f.name != "dt"])
        mark = hashlib.md5(text.encode()).hexdigest()
        if any(f.endswith(mark) and f[5:15] <= dt for f in child_folders(self.spark, folder)):
            return
        (self.spark.createDataFrame([(dt, text)], "since string, columns string").coalesce(1)
         .write.mode("overwrite").json(f"{folder}/from={dt}-{mark}"))

    def recorded_schema(self, layer: str, source: str, upto: str = "9999-12-31") -> StructType | None:
        """Columns of all snapshots not after a date, by the schemas noted as they were saved.

        A column whose type changed is refused.  None where nothing was noted.
        """
        folder = f"{self.base.rstrip('/')}/_schemas/{layer}/{source}"
        noted = [f for f in child_folders(self.spark, folder) if f.startswith("from=") and f[5:15] <= upto]
        if not noted:
            return None
        rows = self.spark.read.schema("since string, columns string").json(
            [f"{folder}/{f}" for f in noted]).orderBy("since", "columns").collect()
        types: dict[str, str] = {}
        for row in rows:
            for name, kind in json.loads(row["columns"]):
                if types.setdefault(name, kind) != kind:
                    raise ValueError(f"{layer}/{source}: {name} is {types[name]} in one snapshot "
                                     f"and {kind} in another")
        return StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in types.items()))

    def save_profile(self, df: DataFrame, layer: str, source: str, dt: str) -> DataFrame:
        """Snapshot metadata beside the data: profile, hash and size, as JSON.

        Counts and hash come from one pass over the snapshot.
        """
        columns = F.array(*[
            F.struct(F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.count_if(F.col(f"`{f.name}`").isNull()).alias("null_count"))
            for f in df.schema.fields])
        meta = df.agg(F.count(F.lit(1)).alias("record_count"), columns.alias("columns"),
                      content_sum(df.columns).alias("content_hash")).select(
            F.lit(source).alias("source"), F.lit(layer).alias("layer"), F.lit(dt).alias("dt"),
            F.lit(self.size(layer, source, dt)).cast("bigint").alias("size_bytes"),
            "record_count", "columns", "content_hash")
        path = f"{self.base.rstrip('/')}/_profiles/{layer}/{source}/dt={dt}"
        meta.write.mode("overwrite").json(path)
        return self.spark.read.schema(meta.schema).json(path)

    # Reading

    def dates(self, layer: str, source: str) -> list[str]:
        """Dates of finished snapshots: those marked one by one or written by date."""
        root = self.path(layer, source)
        by_date = is_finished(self.spark, root)
        return sorted(f[3:] for f in child_folders(self.spark, root) if f.startswith("dt=")
                      and (by_date or is_finished(self.spark, f"{root}/{f}")))

    def snapshot(self, layer: str, source: str, dt: str, fmt: str = "parquet",
                 schema: StructType | None = None) -> DataFrame:
        """All files of one date; other dates are not listed."""
        reader = self.spark.read.format(_check_format(fmt))
        if schema is not None:
            reader = reader.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True)
        return reader.load(self.path(layer, source, dt))

    def latest(self, layer: str, source: str, fmt: str = "parquet",
               schema: StructType | None = None) -> DataFrame:
        return self.as_of(layer, source, "9999-12-31", fmt, schema)

    def as_of(self, layer: str, source: str, date: str, fmt: str = "parquet",
              schema: StructType | None = None) -> DataFrame:
        """The newest snapshot not after a date."""
        usable = [d for d in self.dates(layer, source) if d <= date]
        if not usable:
            raise FileNotFoundError(f"no snapshot of {layer}/{source} up to {date}")
        return self.snapshot(layer, source, usable[-1], fmt, schema)

    def all_dates(self, layer: str, source: str, upto: str = "9999-12-31") -> DataFrame:
        """Every finished snapshot not after a date, columns united by name, with ``dt``.

        The columns come from the noted schemas, so no footer is opened to learn them.
        """
        usable = [d for d in self.dates(layer, source) if d <= upto]
        if not usable:
            raise FileNotFoundError(f"no snapshot of {layer}/{source} up to {upto}")
        root = self.path(layer, source)
        schema = self.recorded_schema(layer, source, upto)
        reader = self.spark.read.option("basePath", root)
        # Without a note, as in a lake of earlier days, the footers of all files must be opened.
        reader = (reader.option("mergeSchema", True) if schema is None
                  else reader.schema(schema.add("dt", "string")))
        return (reader.parquet(*[f"{root}/dt={d}" for d in usable])
                .withColumn("dt", F.col("dt").cast("string")))

    def size(self, layer: str, source: str, dt: str) -> int:
        """Bytes of one snapshot, from the file system's own summary."""
        fs, folder = _file_system(self.spark, self.path(layer, source, dt))
        return fs.getContentSummary(folder).getLength()
