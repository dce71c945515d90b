"""affinity: similar-user search and recommendation on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames; column names are
parameters, so the operators work on any (user, item, value, time) table.
"""

from affinity.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
