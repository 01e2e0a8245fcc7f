"""Layer sinks: full-overwrite writes with a read-back hand-off.

Without a transactional table format a plain ``overwrite`` of the path being
read is unsafe, so each run writes to a fresh versioned folder
``<root>/<layer>_<table>/run=<id>`` and the *written* data is what the next
layer reads. The audit timestamp is added here, at the sink, so that every
upstream builder stays deterministic and comparable.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class WriteVerificationError(RuntimeError):
    """A stored table does not hold the rows that were written."""


ROWS = "__rows"


@dataclass
class Written:
    """A layer's tables as written: their paths, and what was counted while the rows went
    by (``ROWS`` and the metrics asked for) — no stored table is read for it."""

    paths: dict[str, str]
    observed: dict[str, dict[str, int]] = field(default_factory=dict)

    def rows(self) -> dict[str, int]:
        return {name: values[ROWS] for name, values in self.observed.items()}


def with_audit_timestamp(df: DataFrame, column: str) -> DataFrame:
    return df.select("*", F.current_timestamp().alias(column))


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, list[str]] | None = None,
    catalog_table: str | None = None,
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> str:
    """Overwrite ``path``. With ``bucket_by=(n, cols)`` the data is also
    hash-bucketed and sorted by ``cols`` and registered as the external
    catalog table ``catalog_table`` (bucketing lives in the catalog), so
    later joins and aggregations on those columns need no shuffle. The rows
    are first dealt by the same columns into ``n`` partitions, so a bucket is
    one file however many tasks computed the table. ``watch`` is put on the rows
    directly before the write, in the tasks that write."""
    writer = (df if bucket_by else watch(df)).write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        if not catalog_table:
            raise ValueError("a bucketed table needs a catalog table name")
        n, cols = bucket_by
        writer = watch(df.repartition(n, *cols)).write.mode("overwrite").format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.bucketBy(n, *cols).sortBy(*cols).option("path", path).saveAsTable(catalog_table)
    else:
        writer.save(path)
    return path


def write_observed(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    layer: str,
    fmt: str = "parquet",
    audit_column: str | None = None,
    run_id: str | None = None,
    partition_by: dict[str, list[str]] | None = None,
    max_parallel: int = 4,
    buckets: dict[str, tuple[int, list[str]]] | None = None,
    catalog_tables: dict[str, str] | None = None,
    metrics: dict[str, dict[str, Column]] | None = None,
) -> Written:
    """Write every table of a layer to a fresh run folder, counting its rows and evaluating
    ``metrics`` (table -> name -> aggregate) on the way.

    The tables are independent jobs, so they are submitted concurrently from
    driver threads (the scheduler interleaves their tasks on the executors).
    The aggregates are observed in the tasks that write: a task that is run again counts once,
    and what comes to the driver is one row per table."""
    run_id = run_id or uuid.uuid4().hex
    paths = {name: f"{root.rstrip('/')}/{layer}_{name}/run={run_id}" for name in tables}

    def write(name: str) -> dict[str, int]:
        df = tables[name]
        out = df if audit_column is None else with_audit_timestamp(df, audit_column)
        seen = Observation(f"{layer}_{name}_{uuid.uuid4().hex}")
        wanted = {ROWS: F.count(F.lit(1)), **(metrics or {}).get(name, {})}
        write_table(out, paths[name], fmt, (partition_by or {}).get(name), (buckets or {}).get(name),
                    (catalog_tables or {}).get(name), lambda rows: rows.observe(seen, *[c.alias(n) for n, c in wanted.items()]))
        return seen.get

    with ThreadPoolExecutor(max_workers=max(1, min(len(tables), max_parallel))) as pool:
        return Written(paths, dict(zip(tables, pool.map(write, tables))))


def write_layer(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    layer: str,
    fmt: str = "parquet",
    audit_column: str | None = None,
    run_id: str | None = None,
    partition_by: dict[str, list[str]] | None = None,
    max_parallel: int = 4,
    buckets: dict[str, tuple[int, list[str]]] | None = None,
    catalog_tables: dict[str, str] | None = None,
) -> dict[str, str]:
    """:func:`write_observed` without further metrics; returns name -> path."""
    return write_observed(spark, tables, root, layer, fmt, audit_column, run_id, partition_by, max_parallel, buckets,
                          catalog_tables).paths


def read_layer(
    spark: SparkSession,
    paths: dict[str, str],
    fmt: str = "parquet",
    schemas: dict[str, StructType] | None = None,
    catalog_tables: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Read stored layer tables; known schemas skip the inference job and
    catalog tables keep their bucketing."""
    out = {}
    for name, path in paths.items():
        if catalog_tables and name in catalog_tables:
            out[name] = spark.table(catalog_tables[name])
            continue
        reader = spark.read.format(fmt)
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        out[name] = reader.load(path)
    return out


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``(table_name, row_count)`` — a UNION ALL of counts."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def stored_rows(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of stored tables, from their files' footers: the scans read no column."""
    counts = [df.select().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    return {r["name"]: r["n"] for r in reduce(DataFrame.unionByName, counts).collect()} if counts else {}


def verify_rows(written: Written, stored: dict[str, DataFrame]) -> dict[str, int]:
    """The rows of every stored table; raises unless the files hold as many as were written."""
    found = stored_rows(stored)
    lost = {name: (n, found.get(name)) for name, n in written.rows().items() if found.get(name) != n}
    if lost:
        raise WriteVerificationError("rows written and rows stored differ: " +
                                     ", ".join(f"{name} {n} against {m}" for name, (n, m) in sorted(lost.items())))
    return found


def stage_tables(spark: SparkSession, tables: dict[str, DataFrame], root: str, fmt: str = "parquet",
                 max_parallel: int = 4) -> dict[str, DataFrame]:
    """Write derived tables once to ``root`` (a shared folder) and return the
    stored copies, so several consumers scan them instead of recomputing
    their lineage; also cuts that lineage against executor loss."""
    if not tables:
        return {}
    paths = write_layer(spark, tables, root, "staged", fmt, max_parallel=max_parallel)
    return read_layer(spark, paths, fmt, {n: df.schema for n, df in tables.items()})
