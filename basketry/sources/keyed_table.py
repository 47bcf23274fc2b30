"""A feature table by key that is changed and read in parts.

Rows lie in folders by a bucket of their key, inside sorted by the key, with small row groups and
Bloom filters.  An upsert rewrites the buckets that its rows touch and leaves all other files as
they are; a lookup opens the buckets of its ids, and of their files the row groups that may hold
one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from basketry.operators.upsert import upsert
from basketry.session import drop_paths, materialise, scratch_scope

BUCKET = "key_bucket"


@dataclass(frozen=True)
class KeyedTable:
    """``buckets`` is fixed when the table is begun: rows / buckets is what an upsert of one row
    writes, so a bucket should hold some hundred megabytes at most."""

    spark: SparkSession
    path: str
    key: str
    schema: StructType
    buckets: int = 64
    group_bytes: int = 8 << 20

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).alias(BUCKET)

    def _write(self, rows: DataFrame) -> None:
        """Replace the buckets that ``rows`` fall into."""
        dealt = rows.select(*self.schema.names, self._bucket(F.col(self.key)))
        with scratch_scope() as own:
            ready = materialise(dealt, "keyed-rows")  # may come from the files to be replaced
        (ready.repartition(BUCKET).sortWithinPartitions(BUCKET, self.key).write.mode("overwrite")
         .partitionBy(BUCKET).option("partitionOverwriteMode", "dynamic")
         .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
         .option("parquet.block.size", self.group_bytes)
         .option("parquet.block.size.row.check.min", 100).parquet(self.path))
        drop_paths(self.spark, own)

    def begin(self, rows: DataFrame) -> None:
        """The first rows, with unique keys."""
        self._write(rows)

    def read(self) -> DataFrame:
        return self._read().select(*self.schema.names)

    def _read(self) -> DataFrame:
        whole = StructType([*self.schema.fields, StructField(BUCKET, LongType())])
        return self.spark.read.schema(whole).parquet(self.path)

    def _touched(self, keys: DataFrame) -> list[int]:
        """Buckets of these keys, no more than there are buckets."""
        return [r[0] for r in keys.select(self._bucket(F.col(self.key))).distinct().collect()]

    def upsert(self, new: DataFrame) -> int:
        """Rows of ``new`` replace those with their keys; gives the number of buckets rewritten.

        Repeating it changes nothing, so a run that broke off between two buckets is repeated.
        """
        new = new.select(*self.schema.names)
        touched = self._touched(new)
        if touched:
            old = self._read().where(F.col(BUCKET).isin(touched)).select(*self.schema.names)
            self._write(upsert(old, new, [self.key]))
        return len(touched)

    def lookup(self, ids) -> DataFrame:
        """Rows of a list of ids, or of a single-column DataFrame of them."""
        if not isinstance(ids, DataFrame):
            known = self.schema[self.key].dataType
            ids = list(ids)
            wanted = self.spark.createDataFrame([(i,) for i in ids],
                                                StructType([StructField(self.key, known)]))
            return (self._read().where(F.col(BUCKET).isin(self._touched(wanted))
                                       & F.col(self.key).isin(ids)).select(*self.schema.names))
        wanted = ids.select(F.col(ids.columns[0]).alias(self.key)).distinct()
        opened = self._read().where(F.col(BUCKET).isin(self._touched(wanted)))
        return opened.join(wanted, self.key, "left_semi").select(*self.schema.names)
