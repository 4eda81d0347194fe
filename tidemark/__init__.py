"""tidemark: keep large collections of time series complete and current, on Spark.

Every operator is a DataFrame -> DataFrame (or Column -> Column) transformation over
all series at once; Catalyst plans it, Spark shuffles and spills it.
"""

from tidemark.session import configure, shared_dir

__all__ = ["configure", "shared_dir"]
