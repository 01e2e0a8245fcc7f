"""What a model allows, as rows: for every measure and table whether the table's columns may group
or filter the measure, over how many paths, and what the table shows and hides.

A measure is reached by a table if every base measure under it is. The answer is not read off
the relationships alone: each pair is put to the metric layer, which raises where a grouping
is not allowed. Models with two paths between tables raise (see :meth:`Model.path`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans.metrics import Model, ModelError, _base_closure, _Branch


def groupable(model: Model, measure: str, table: str) -> bool:
    """Whether the metric layer groups the measure by the table's columns."""
    column = model.tables[table].columns[0]
    try:
        for name in _base_closure(model, [measure]):
            base = model.measures[name]
            _Branch(model, base.table, [base], [(table, column)], {})
    except ModelError as error:
        if "ambiguous" in str(error):
            raise
        return False
    return True


def model_audit(model: Model) -> DataFrame:
    """measure, home, table_name, paths, groupable, shown_columns, hidden_columns (their names),
    table_rows. ``paths``: from the home tables of the measure's base measures, the fewest.

    One count per table is the only read of data."""
    rows = []
    for measure in model.measures:
        homes = sorted({model.measures[n].table for n in _base_closure(model, [measure])})
        for table, df in model.tables.items():
            hidden = sorted(set(df.columns) & set(model.hidden.get(table, ())))
            rows.append((measure, ", ".join(homes), table, min(len(model.paths(h, table)) for h in homes), groupable(model, measure, table),
                         len(model.business_view(table).columns), ", ".join(hidden)))
    spark = next(iter(model.tables.values())).sparkSession
    pairs = spark.createDataFrame(rows, "measure string, home string, table_name string, paths int, groupable boolean, "
                                        "shown_columns int, hidden_columns string")
    counts = reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("table_rows")).select(F.lit(t).alias("__t"), "table_rows")
                                            for t, df in model.tables.items()])
    return pairs.join(F.broadcast(counts), F.col("table_name") == F.col("__t")).drop("__t")  # one row per table
