"""tallyspark: revenue analytics and incremental table maintenance on PySpark.

Models are plain functions from DataFrames to a DataFrame; Catalyst plans them.
Stored-table maintenance (merge, delete+insert, deduplicated append, compaction)
lives in :mod:`tallyspark.sinks`; checks in :mod:`tallyspark.operators.checks`.
"""

from tallyspark.params import Params
from tallyspark.session import get_session, scratch_dir

__all__ = ["Params", "get_session", "scratch_dir"]
