"""Display formats for measures (``0``, ``#,0``, ``0.0``, ``0.00``, ``0.0%``).

Values are rounded first and only then printed, so the text never depends
on how a particular printf rounds a binary fraction. Blank stays blank.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_measure(c: Column, fmt: str) -> Column:
    if fmt == "0.0%":
        text = F.format_string("%.1f%%", F.round(c.cast("double") * 100, 1))
    elif fmt == "#,0":
        text = F.format_number(F.round(c.cast("double"), 0), 0)
    elif fmt in ("0.0", "0.00"):
        digits = len(fmt.split(".")[1])
        text = F.format_string(f"%.{digits}f", F.round(c.cast("double"), digits))
    elif fmt == "0":
        text = F.round(c.cast("double"), 0).cast("bigint").cast("string")
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return F.when(c.isNotNull(), text)


def format_percent(c: Column, decimals: int = 1) -> Column:
    return F.when(c.isNotNull(), F.format_string(f"%.{decimals}f%%", F.round(c.cast("double") * 100, decimals)))
