"""Catalog registration, so business questions can be asked in SQL text.

* :func:`register_views` — session temp views over (lazy) DataFrames, and
  :func:`session_views`, which takes them away again;
* :func:`register_tables` — external catalog tables over stored layer
  folders: metadata only, the data stays where the layer run wrote it. The
  database itself is created with an explicit location (the shared scratch
  folder), never the default local warehouse directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> dict[str, str]:
    names = {}
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names[name] = view
    return names


@contextmanager
def session_views(spark: SparkSession, tables: dict[str, DataFrame]) -> Iterator[str]:
    """Views under a prefix of their own, dropped at the end; yields the prefix.

    SQL text is resolved when ``spark.sql`` is called, so a DataFrame made inside
    keeps its plan; two callers in one session do not see each other's views."""
    prefix = f"v{uuid.uuid4().hex[:12]}_"
    views = register_views(tables, prefix)
    try:
        yield prefix
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def register_tables(
    spark: SparkSession,
    paths: dict[str, str],
    database: str,
    location: str,
    prefix: str = "",
    fmt: str = "parquet",
) -> dict[str, str]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    names = {}
    for name, path in paths.items():
        full = f"{database}.{prefix}{name}"
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.catalog.createTable(full, path=path, source=fmt)
        names[name] = full
    return names
