"""Shared helpers of the training-data operators."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

LAST_DOC = 2**63 - 1  # stands for a null doc_id where an order is needed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark (works for any store Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(mod)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage: a lost executor later costs a re-read, not a recompute."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored_by(df: DataFrame, name: str, key: str, buckets: int) -> Iterator[DataFrame]:
    """``df`` written once to the shared scratch folder in ``buckets`` by ``key``, and read back
    from there: joins by ``key`` in as many partitions then find its rows in place, unmoved.

    The buckets are known to the catalog only inside the ``with`` block; a plan made there and
    derived ones keep them. ``df`` should be dealt by ``key`` already, as a join by it is."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    entry = f"`{path.rsplit('/', 1)[1].replace('-', '_')}`"
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(entry, format="parquet")
    try:
        yield spark.read.table(entry)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {entry}")  # the files stay, as those of ``stored``


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``: bounds what a worker unpacks at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def parts_for(rows: int, rows_per_part: int, least: int = 1) -> int:
    """How many pieces keep each at or below ``rows_per_part`` on average."""
    return max(least, math.ceil(rows / rows_per_part))


def order_key(doc_id: str) -> Column:
    """doc_id with null replaced by the largest long: null sorts after every id."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_DOC))


def text_key(text: str) -> Column:
    """A text's key, never null: its SHA-256 digest, or the empty string for null."""
    return F.coalesce(F.sha2(F.col(text).cast("string").cast("binary"), 256), F.lit(""))
