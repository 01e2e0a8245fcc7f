"""Layered (Bronze → Silver → Gold) builds with a quality gate per layer.

``run_layer`` computes each table of a layer exactly once:

1. build the layer's tables lazily from the previous layer's stored tables;
2. write each to a fresh run folder (``<root>/<layer>_<table>/run=<id>``); row
   counts and the checks that are plain aggregates (rows, nulls, ranges) are
   observed in the writing tasks, and the row counts held against the files' footers;
3. run the layer's other checks over the **stored** tables (cheap scans, no
   recomputation of the build) and gate: any failed error-severity check
   raises before the layer is handed on, and drops the run's catalog tables;
4. publish the run under the next number (``sources.manifest.publish``) —
   readers of the layer (``sources.manifest.published``) only ever see runs
   that passed their checks — and hand the stored tables on.

Writing before checking avoids the double execution of "check, then write"
(the same lazy plan evaluated twice, possibly with different survivors),
and the stored tables cut the lineage so a lost executor never forces a
recomputation from raw files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from strata.operators.quality import Check, QualityGateError, gate, observable, run_checks
from strata.sources.manifest import publish
from strata.sources.sinks import WriteVerificationError, read_layer, verify_rows, write_observed

Builder = Callable[[dict[str, DataFrame]], dict[str, DataFrame]]


@dataclass
class Layer:
    name: str
    build: Builder
    checks: list[Check] = field(default_factory=list)
    audit_column: str | None = None
    partition_by: dict[str, list[str]] = field(default_factory=dict)
    # table -> (number of buckets, columns): stored hash-bucketed and sorted,
    # registered in the run's catalog database so readers keep the layout. The
    # caller chooses the number for the table's size (a bucket is read by one task)
    buckets: dict[str, tuple[int, list[str]]] = field(default_factory=dict)


@dataclass
class LayerResult:
    name: str
    paths: dict[str, str]
    tables: dict[str, DataFrame]
    check_rows: list
    checks: DataFrame | None
    counts: dict[str, int]
    version: int

    def row_counts(self) -> DataFrame:
        """(table_name, row_count), as counted during the write and found in the stored files' footers."""
        spark = next(iter(self.tables.values())).sparkSession
        return spark.createDataFrame([(f"{self.name}_{t}", n) for t, n in self.counts.items()],
                                     "table_name string, row_count bigint")


def run_layer(
    spark: SparkSession,
    layer: Layer,
    inputs: dict[str, DataFrame],
    root: str,
    fmt: str = "parquet",
    run_id: str | None = None,
) -> LayerResult:
    run_id = run_id or uuid.uuid4().hex
    built = layer.build(inputs)
    catalog_tables = {}
    if layer.buckets:
        database = layer_database(spark, root)
        catalog_tables = {name: f"{database}.{layer.name}_{name}_{run_id}" for name in layer.buckets}
    written = write_observed(spark, built, root, layer.name, fmt, layer.audit_column, run_id, layer.partition_by,
                             buckets=layer.buckets, catalog_tables=catalog_tables, metrics=observable(layer.checks, list(built)))
    paths = written.paths
    schemas = {name: df.schema for name, df in built.items()} if layer.audit_column is None else None
    stored = read_layer(spark, paths, fmt, schemas, catalog_tables)
    checks, rows = None, []
    try:
        counts = verify_rows(written, stored)
        if layer.checks:
            checks = run_checks({**inputs, **stored}, layer.checks, layer.name, known=written.observed)
            rows = gate(checks)  # raises before the run is published
    except (QualityGateError, WriteVerificationError):
        for table in catalog_tables.values():
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    number = publish(spark, root, layer.name, paths, run_id, fmt, catalog_tables, layer.buckets)
    return LayerResult(layer.name, paths, stored, rows, checks, counts, number)


def layer_database(spark: SparkSession, root: str) -> str:
    """A catalog database for the bucketed tables of runs under ``root``;
    its location is inside ``root`` (shared storage), never the local
    default warehouse."""
    name = "strata_layers_" + uuid.uuid5(uuid.NAMESPACE_URL, root).hex[:12]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root.rstrip('/')}/_catalog'")
    return name


def run_layers(
    spark: SparkSession,
    layers: list[Layer],
    sources: dict[str, DataFrame],
    root: str,
    fmt: str = "parquet",
) -> list[LayerResult]:
    """Run layers in order; each sees the stored tables of all earlier ones."""
    run_id = uuid.uuid4().hex
    available = dict(sources)
    results = []
    for layer in layers:
        result = run_layer(spark, layer, available, root, fmt, run_id)
        available.update(result.tables)
        results.append(result)
    return results


def check_report(results: list[LayerResult]) -> DataFrame | None:
    """All layers' check rows as one DataFrame.

    Built from the rows the gate already collected (one per check), so the
    checks are not executed a second time."""
    with_checks = [r for r in results if r.checks is not None]
    if not with_checks:
        return None
    schema = StructType([StructField(f.name, f.dataType, True) for f in with_checks[0].checks.schema.fields])
    rows = [row for r in with_checks for row in r.check_rows]
    return with_checks[0].checks.sparkSession.createDataFrame(rows, schema)
