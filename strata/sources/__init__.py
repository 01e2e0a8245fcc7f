"""Sources and sinks: declared schemas, raw readers, layer writers."""

from strata.sources.ingest import load_tables, read_csv, read_parquet, read_table, with_ingest_metadata
from strata.sources.schema import ColumnSpec, SchemaMismatch, TableSpec, assert_schema, schema_diff, spec
from strata.sources.sinks import read_layer, row_counts, with_audit_timestamp, write_layer, write_table

__all__ = [
    "ColumnSpec",
    "SchemaMismatch",
    "TableSpec",
    "assert_schema",
    "load_tables",
    "read_csv",
    "read_layer",
    "read_parquet",
    "read_table",
    "row_counts",
    "schema_diff",
    "spec",
    "with_audit_timestamp",
    "with_ingest_metadata",
    "write_layer",
    "write_table",
]
