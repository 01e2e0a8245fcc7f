"""Readers for the raw layer.

CSV is read with the declared all-text schema: header row, PERMISSIVE mode
(short rows are padded with nulls, extra fields dropped) and empty fields
as null. Parquet and catalog tables are read as they are. Ingestion metadata
(load timestamp and source file) is added as two columns.

:func:`ingest_csv` reads a file once and keeps apart the rows that do not have the
declared number of fields: they go to a reject table with their file and text instead of
being padded or cut.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from strata.sources.schema import TableSpec


def read_csv(
    spark: SparkSession,
    path: str,
    table: TableSpec,
    source_file: str | None = None,
    with_metadata: bool = True,
    delimiter: str = ",",
) -> DataFrame:
    df = (
        spark.read.schema(table.raw_schema())
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("nullValue", "")
        .option("sep", delimiter)
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return with_ingest_metadata(df, source_file) if with_metadata else df


#: kinds of rejected rows: fewer or more fields than declared, or the declared number but unreadable
REJECT_KINDS = ("short", "long", "unreadable")


@dataclass
class CsvIngest:
    accepted: DataFrame      # the declared columns and the ingestion metadata
    rejected: DataFrame      # source_file, row_text, fields, kind
    counts: dict[str, int]   # accepted and each of REJECT_KINDS, counted while the rows were stored


def field_count(row_text: Column, delimiter: str) -> Column:
    """Fields of a CSV row: the delimiters outside quoted stretches, and one."""
    bare = F.regexp_replace(row_text, r'"(\\.|[^"\\])*"', "")
    return F.size(F.split(bare, re.escape(delimiter)))


def ingest_csv(spark: SparkSession, path: str, table: TableSpec, stored: str, source_file: str | None = None,
               delimiter: str = ",", header: bool = True) -> CsvIngest:
    """Read a CSV once against its declared schema and store it under ``stored``: ``accepted`` rows,
    and ``rejected`` ones with the text they had in the file.

    Both tables come from one stored pass (``rows``, by ``rejected``), so neither reads the file
    again; the counts are observed in that pass."""
    corrupt = "_row_text"
    while corrupt in table.column_names:
        corrupt = f"_{corrupt}"
    df = (spark.read.schema(StructType([*table.raw_schema().fields]).add(corrupt, StringType()))
          .option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
          .option("nullValue", "").option("sep", delimiter).option("encoding", "UTF-8").csv(path))
    fields = field_count(F.col(corrupt), delimiter)
    n = len(table.columns)
    kind = F.when(F.col(corrupt).isNotNull(), F.when(fields < n, "short").when(fields > n, "long").otherwise("unreadable"))
    rows = with_ingest_metadata(df, source_file).withColumns({"_fields": fields, "_kind": kind, "rejected": F.col(corrupt).isNotNull()})
    seen = Observation()
    counted = {"accepted": F.count_if(~F.col("rejected")), **{k: F.count_if(F.col("_kind") == k) for k in REJECT_KINDS}}
    rows.observe(seen, *[c.alias(name) for name, c in counted.items()]).write.partitionBy("rejected").parquet(f"{stored}/rows")
    kept = spark.read.schema(rows.schema).parquet(f"{stored}/rows")
    accepted = kept.filter("NOT rejected").drop(corrupt, "_fields", "_kind", "rejected")
    rejected = kept.filter("rejected").select("source_file", F.col(corrupt).alias("row_text"), F.col("_fields").alias("fields"),
                                              F.col("_kind").alias("kind"))
    return CsvIngest(accepted, rejected, seen.get)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None,
                 schema: StructType | None = None) -> DataFrame:
    """Parquet scan. With a declared ``schema`` no file is opened to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def with_ingest_metadata(
    df: DataFrame,
    source_file: str | None = None,
    timestamp_col: str = "ingestion_timestamp",
    file_col: str = "source_file",
) -> DataFrame:
    """Add the load timestamp and the source file name.

    ``source_file=None`` takes the real file name from the hidden
    ``_metadata`` column, which stays correct when one path globs many files.
    """
    name: Column = F.lit(source_file) if source_file is not None else F.col("_metadata.file_name")
    return df.select("*", F.current_timestamp().alias(timestamp_col), name.alias(file_col))


def load_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """Parquet tables named ``<root>/<name>.parquet``."""
    return {n: read_parquet(spark, f"{root.rstrip('/')}/{n}.parquet") for n in names}
