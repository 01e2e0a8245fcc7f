"""Exact distinct counts as a stored state that can be added up.

A count of distinct values cannot be added: region counts do not sum to the total. What
can be merged is the set itself. Every value gets a dense number once (:func:`dense_ids`, a
stored dictionary); a set is then kept per key in buckets of 32768 numbers, as the sorted
positions while they are few and as a bitmap beyond (``SPARSE``). Buckets of the
same key are merged with OR, so the state of a coarser key comes from the finer one
(:func:`coarser`) and counts come from either (:func:`distinct_counts`) without the rows.

A blank (null) value is kept as a flag beside the buckets, because a measure counts
blank once and SQL does not count it.

Sizes: at most 4 KB a bucket; a key has no more buckets than its values, nor than the
dictionary has. Rows are made distinct before anything is shuffled, so a value with a third
of all rows is one row per task and key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType

from strata.session import scratch_path

SPARSE = 256  # positions up to which a bucket is kept as a list
STATE = ("measure", "bucket", "positions", "bits", "blank")


def _text(column: str, kind: DataType) -> Column:
    """A value as text, equal texts for equal values (0.0 and -0.0 are one value)."""
    c = F.col(column)
    return ((c + F.lit(0.0)) if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType) else c).cast("string")


def members(df: DataFrame, keys: Sequence[str], columns: dict[str, str], present: dict[str, Column] | None = None) -> DataFrame:
    """keys, measure, value: each key's different values of every column, in one read.

    ``columns``: measure -> column; ``present``: measure -> rows that count (others are left out)."""
    every = [F.struct(F.lit(m).alias("measure"), _text(c, df.schema[c].dataType).alias("value"),
                      F.coalesce((present or {}).get(m, F.lit(True)), F.lit(False)).alias("counts")) for m, c in columns.items()]
    return df.select(*keys, F.inline(F.array(*every))).filter("counts").select(*keys, "measure", "value").distinct()


def dense_ids(values: DataFrame) -> DataFrame:
    """A stored dictionary (measure, value, id) of the different ``values`` (measure, value).

    Numbers run from 0 without gaps: rows are numbered within each stored partition, and the
    partitions' sizes (one row each) make the offsets."""
    spark = values.sparkSession
    path = scratch_path(spark, "dense-ids")
    numbered = values.filter(F.col("value").isNotNull()).select("measure", "value").distinct()
    numbered = numbered.sortWithinPartitions("measure").withColumn("place", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    part, at = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    offsets, total = [], 0
    for r in stored.groupBy(part.alias("part")).count().orderBy("part").collect():
        offsets.append((r["part"], total))
        total += r["count"]
    shift = spark.createDataFrame(offsets, "part bigint, shift bigint")  # one row per partition
    return (stored.withColumn("part", part).join(F.broadcast(shift), "part")
            .select("measure", "value", (F.col("shift") + at).alias("id")))


def distinct_state(sets: DataFrame, keys: Sequence[str], ids: DataFrame) -> DataFrame:
    """keys and ``STATE``, from :func:`members` and the dictionary of their values."""
    # in a bucket's own numbering positions start at 0, buckets at 1
    known = ids.select(F.col("measure").alias("__m"), F.col("value").alias("__v"),
                       F.bitmap_bucket_number(F.col("id") + 1).alias("bucket"), F.bitmap_bit_position(F.col("id") + 1).alias("position"))
    placed = sets.join(known, (F.col("measure") == F.col("__m")) & (F.col("value") == F.col("__v")), "left")
    own = [F.col(k) for k in keys]
    grouped = placed.groupBy(*own, "measure", "bucket").agg(
        F.bitmap_construct_agg("position").alias("bits"), F.sort_array(F.collect_list(F.col("position").cast("smallint"))).alias("positions"),
        F.max(F.col("value").isNull()).alias("blank"))
    few = F.size("positions") <= SPARSE
    return grouped.select(*own, "measure", "bucket", F.when(few, F.col("positions")).alias("positions"),
                          F.when(~few, F.col("bits")).alias("bits"), "blank")


def _merged(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One bitmap per key, measure and bucket."""
    by = [*keys, "measure", "bucket"]
    lists = (state.filter(F.col("bits").isNull()).select(*by, "blank", F.explode_outer("positions").alias("position")).groupBy(*by)
             .agg(F.bitmap_construct_agg("position").alias("bits"), F.max("blank").alias("blank")))
    maps = state.filter(F.col("bits").isNotNull()).select(*by, "bits", "blank")
    return lists.unionByName(maps).groupBy(*by).agg(F.bitmap_or_agg("bits").alias("bits"), F.max("blank").alias("blank"))


def coarser(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of fewer keys, merged from the finer one; bitmaps stay bitmaps."""
    return _merged(state, keys).select(*keys, "measure", "bucket", F.lit(None).cast("array<smallint>").alias("positions"), "bits", "blank")


def distinct_counts(state: DataFrame, keys: Sequence[str], measures: Sequence[str], blank: bool = False) -> DataFrame:
    """keys and one count per measure; ``blank``: a blank value counts once."""
    per = _merged(state, keys).groupBy(*keys, "measure").agg(
        F.sum(F.bitmap_count("bits")).alias("n"), F.max(F.col("blank").cast("int")).alias("blank"))
    n = F.col("n") + F.col("blank") if blank else F.col("n")
    return per.groupBy(*keys).agg(*[F.coalesce(F.max(F.when(F.col("measure") == m, n)), F.lit(0)).alias(m) for m in measures])
