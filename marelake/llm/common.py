"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marelake.session import shared_dir

#: the white space the text contracts name: space and the control characters 9 to 13
BLANKS = " \t\n\x0b\x0c\r"


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage.

    A lost executor costs nothing that is already written, and what reads the
    result never computes it a second time.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of a table; null text becomes the empty text, other columns go."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(c, upper, upper.lower())


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``: the folds of the learning operators."""
    return F.crc32(doc_id.cast("string")) % F.lit(modulus)


def arrow_map(df: DataFrame, rows: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` of a function from a record batch to a dict of columns (or None)."""
    fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    target = arrow_schema(fields)

    def run(batches):
        step = rows() if isinstance(rows, type) else rows
        for batch in batches:
            if batch.num_rows:
                out = step(batch)
                if out is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(run, fields)


def arrow_schema(fields: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)


def to_numpy(column):
    """An Arrow integer or floating column without nulls as a numpy array."""
    return column.to_numpy(zero_copy_only=False)
