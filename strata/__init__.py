"""strata — layered analytics models on Spark DataFrames.

Raw files are read against declared schemas (``sources``), cleaned and typed
from declarative specs (``functions.clean``), gated by data-quality checks
that are ordinary DataFrame queries (``operators.quality``), shaped into star
schemas (``plans.star``) and queried through a metric layer whose measures
are evaluated in a filter context (``plans.metrics``).

Everything is lazy: builders return DataFrames and never collect; the only
driver round-trips are the quality gate (one row per check) and writes.
"""

__version__ = "0.1.0"
