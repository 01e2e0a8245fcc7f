"""Declared table schemas.

A :class:`TableSpec` lists the columns of one source in file order with the
type each column has once cleaned. The raw (Bronze) schema reads every column
as text so that nothing is lost or rejected at ingest; typing is done later
with ``try_cast`` (see :mod:`strata.functions.clean`).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def data_type(name: str) -> T.DataType:
    try:
        return _TYPES[name]
    except KeyError:
        return T._parse_datatype_string(name)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str = "string"
    nullable: bool = True


@dataclass(frozen=True)
class TableSpec:
    """Columns of one source table, in file order, plus its key."""

    name: str
    columns: tuple[ColumnSpec, ...]
    key: tuple[str, ...] = ()
    description: str = ""
    metadata: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def raw_schema(self) -> T.StructType:
        """All-text schema used to read the file; key columns declared non-null."""
        return T.StructType(
            [
                T.StructField(c.name, T.StringType(), c.nullable and c.name not in self.key)
                for c in self.columns
            ]
        )

    def typed_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, data_type(c.dtype), True) for c in self.columns]
        )

    def columns_of_type(self, dtype: str) -> list[str]:
        return [c.name for c in self.columns if c.dtype == dtype]


def spec(name: str, columns: str, key: tuple[str, ...] | list[str] = (), **kw) -> TableSpec:
    """Compact constructor: ``spec('t', 'a string, b int, c date', key=['a'])``."""
    cols = []
    for part in columns.split(","):
        part = part.strip()
        if not part:
            continue
        col_name, _, dtype = part.partition(" ")
        cols.append(ColumnSpec(col_name.strip(), dtype.strip() or "string"))
    return TableSpec(name, tuple(cols), tuple(key), **kw)


def schema_diff(df: DataFrame, expected: T.StructType, check_nullable: bool = False) -> list[str]:
    """Human-readable differences between a DataFrame's schema and ``expected``."""
    problems: list[str] = []
    actual = {f.name: f for f in df.schema.fields}
    wanted = {f.name: f for f in expected.fields}
    for name in wanted:
        if name not in actual:
            problems.append(f"missing column {name}")
            continue
        a, w = actual[name], wanted[name]
        if a.dataType != w.dataType:
            problems.append(f"{name}: {a.dataType.simpleString()} != {w.dataType.simpleString()}")
        if check_nullable and a.nullable and not w.nullable:
            problems.append(f"{name}: nullable but declared not null")
    for name in actual:
        if name not in wanted:
            problems.append(f"unexpected column {name}")
    if not problems and [f.name for f in df.schema.fields] != [f.name for f in expected.fields]:
        problems.append("column order differs")
    return problems


class SchemaMismatch(AssertionError):
    pass


def assert_schema(df: DataFrame, expected: T.StructType, check_nullable: bool = False) -> DataFrame:
    problems = schema_diff(df, expected, check_nullable)
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df
