"""Numbered manifests: which stored run is the current version of a layer.

``<root>/_manifest/<layer>/<number>.json`` lists the tables of one published run. A manifest
is written under a name of its own and then renamed to the next free number; the rename
fails if that number exists, so of two runs that publish at the same time each gets its
own number and none is lost or half read. (The store's rename must refuse an existing target,
as HDFS does at once and local folders do but for a moment.) A reader takes the highest number, or pins one and
goes on reading it whatever is published later. Runs that were never published leave
folders behind; :func:`remove_unpublished` takes those away.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class _Store:
    """The few file operations that Spark's readers and writers do not offer."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        path = self.path(root)
        self.fs = path.getFileSystem(self.conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.makeQualified(path).toUri(), self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[tuple[str, int]]:
        """(name, modification time in ms) of what a folder holds; none if it does not exist."""
        at = self.path(folder)
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def claim(self, source: str, target: str) -> bool:
        """Rename; False if the target exists."""
        options = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            self.context.rename(self.fs.makeQualified(self.path(source)), self.fs.makeQualified(self.path(target)), options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _folder(root: str, layer: str) -> str:
    return f"{root.rstrip('/')}/_manifest/{layer}"


def versions(spark: SparkSession, root: str, layer: str) -> list[int]:
    """The published numbers, ascending."""
    found = (name.removesuffix(".json") for name, _ in _Store(spark, root).names(_folder(root, layer)) if name.endswith(".json"))
    return sorted(int(n) for n in found if n.isdigit())


def publish(spark: SparkSession, root: str, layer: str, paths: dict[str, str], run_id: str, fmt: str = "parquet",
            catalog_tables: dict[str, str] | None = None, buckets: dict[str, tuple[int, list[str]]] | None = None) -> int:
    """Make a checked run the current version of a layer; returns its number.

    A run whose checks failed is never published, so it is never read."""
    store, folder = _Store(spark, root), _folder(root, layer)
    rows = [{"table_name": name, "path": path, "format": fmt, "run_id": run_id, "catalog_table": (catalog_tables or {}).get(name),
             "buckets": list((buckets or {}).get(name) or []), "published_at": time.time()} for name, path in paths.items()]
    draft = f"{folder}/_draft-{uuid.uuid4().hex}"
    store.write(draft, "".join(json.dumps(r) + "\n" for r in rows))
    number = (versions(spark, root, layer) or [0])[-1] + 1
    while not store.claim(draft, f"{folder}/{number:08d}.json"):
        number += 1
    return number


def manifest(spark: SparkSession, root: str, layer: str, number: int | None = None) -> list[dict]:
    """The rows of a version, one per table (the newest if no number is given)."""
    if number is None:
        known = versions(spark, root, layer)
        if not known:
            raise FileNotFoundError(f"no run of layer {layer!r} is published under {root}")
        number = known[-1]
    lines = spark.read.text(f"{_folder(root, layer)}/{number:08d}.json").collect()  # one short line per table
    return [json.loads(r["value"]) for r in lines]


def published(spark: SparkSession, root: str, layer: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version (the newest if no number is given)."""
    return {r["table_name"]: spark.table(r["catalog_table"]) if r["catalog_table"] else spark.read.format(r["format"]).load(r["path"])
            for r in manifest(spark, root, layer, number)}


def published_buckets(spark: SparkSession, root: str, layer: str, number: int | None = None) -> dict[str, tuple[int, list[str]]]:
    """How the bucketed tables of a version are stored: number of buckets and columns."""
    return {r["table_name"]: (r["buckets"][0], r["buckets"][1]) for r in manifest(spark, root, layer, number) if r["buckets"]}


def remove_unpublished(spark: SparkSession, root: str, layer: str, tables: list[str], database: str | None = None,
                       min_age_s: float = 24 * 3600) -> list[str]:
    """Delete the folders (and catalog tables) of runs that no manifest names; returns them.

    Only run folders of ``tables`` are looked at, and only those that nothing was written to for
    ``min_age_s``: a run that is still going on is not published either."""
    store = _Store(spark, root)
    kept = {r["run_id"] for n in versions(spark, root, layer) for r in manifest(spark, root, layer, n)}
    gone = []
    for table in tables:
        folder = f"{root.rstrip('/')}/{layer}_{table}"
        for name, changed in store.names(folder):
            run_id = name.removeprefix("run=")
            if name.startswith("run=") and run_id not in kept and time.time() - changed / 1000 >= min_age_s:
                if database:
                    spark.sql(f"DROP TABLE IF EXISTS {database}.{layer}_{table}_{run_id}")
                store.remove(f"{folder}/{name}")
                gone.append(f"{folder}/{name}")
    return gone


def schema_drift(spark: SparkSession, root: str, layer: str, declared: dict[str, StructType]) -> DataFrame:
    """Declared columns against the stored ones, for every published version.

    Rows: version, table_name, column_name, position, declared, stored, status (same, type
    changed, missing, unexpected, moved). Stored schemas are read from the files; a declared
    table that a version lacks has all its columns missing."""
    rows = []
    for number in versions(spark, root, layer):
        stored = {name: df.schema for name, df in published(spark, root, layer, number).items()}
        for table, wanted in declared.items():
            have = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(stored.get(table, StructType()).fields)}
            shared = [f.name for f in wanted.fields if f.name in have]
            order = sorted(shared, key=lambda n: have[n][0])
            for f in wanted.fields:
                kind, own = f.dataType.simpleString(), have.get(f.name)
                status = ("missing" if own is None else "type changed" if own[1] != kind else
                          "same" if shared.index(f.name) == order.index(f.name) else "moved")
                rows.append((number, table, f.name, own[0] if own else None, kind, own[1] if own else None, status))
            rows += [(number, table, name, at, None, kind, "unexpected") for name, (at, kind) in have.items()
                     if name not in wanted.fieldNames()]
    return spark.createDataFrame(rows, "version int, table_name string, column_name string, position int, declared string, "
                                       "stored string, status string")
