"""eventide — event analytics on Spark DataFrames.

Every operator is a plain function from DataFrame(s) to a DataFrame or a
Column.  Execution is left to Catalyst/Tungsten; nothing here collects
data to the driver except tiny, bounded results (counts, size checks).
"""

from eventide.session import get_spark, configure, scratch_dir  # noqa: F401

__all__ = ["get_spark", "configure", "scratch_dir"]
