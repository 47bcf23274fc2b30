"""What the text operators share: the two columns they read, and Python steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.session import scratch_path, ship_package

# ASCII white space, the bytes of [\x20\x09-\x0D]; bytes.split() parts words at the same ones.
SPACE = b" \t\n\x0b\x0c\r"

_CODEC = "zstd"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def bodies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           whole: bool = False) -> DataFrame:
    """``(doc_id bigint, body binary)``: the UTF-8 bytes of each text, null as empty.

    Other columns are left behind here, so their names cannot clash.  ``whole`` takes them along
    in a struct ``_row``, numbered and without the text, for :func:`restored`.
    """
    text = F.col(f"`{text_col}`")
    rest = F.struct(text.isNull().alias("none"),
                    *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col))
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.coalesce(text.cast("string"), F.lit("")).cast("binary").alias("body"),
                       *([rest.alias("_row")] if whole else []))


def restored(rows: DataFrame, docs: DataFrame, text_col: str = "text",
             text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` from ``rows`` with ``_row``; the text is ``text``, else the body."""
    if text is None:
        text = F.when(~F.col("_row.none"), F.col("body").cast("string"))
    return rows.select(*((text.cast("string") if c == text_col else F.col(f"_row.c{i}")).alias(c)
                         for i, c in enumerate(docs.columns)))


def python_rows(df: DataFrame, step: Callable, schema) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(step, schema)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` written once in files by ``column``, so that later joins on it move the other side only.

    The table is external and leaves the catalogue at once; its files stay in the shared folder.
    """
    spark, width = df.sparkSession, shuffle_width(df.sparkSession)
    table = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(width, column).write.format("parquet").option("path", scratch_path(spark, name))
     .bucketBy(width, column).sortBy(column).saveAsTable(table))
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows


# Packed numbers -------------------------------------------------------------------------------

def pack(values: np.ndarray) -> bytes:
    """Numbers from 0 on: the width first, then their bytes in planes, compressed."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + pa.compress(np.ascontiguousarray(planes.T).tobytes(), _CODEC, asbytes=True)


def unpack(packed: bytes, n: int) -> np.ndarray:
    """``n`` numbers that were packed, as int64 (uint64 bits for hashes)."""
    width = packed[0]
    planes = np.frombuffer(pa.decompress(packed[1:], n * width, _CODEC, asbytes=True), np.uint8) \
        if n else np.empty(0, np.uint8)
    whole = np.zeros((n, 8), np.uint8)
    whole[:, :width] = planes.reshape(width, n).T
    return whole.view("<u8").reshape(-1).view(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending uint64 numbers, as differences."""
    return pack(np.concatenate([values[:1], np.diff(values)]))


def unpack_sorted(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(packed, n).view(np.uint64), dtype=np.uint64)
