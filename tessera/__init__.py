"""tessera: faceted text search over landed web pages, as Spark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns) and stays
lazy: nothing is collected to the driver.  See README.md for the map from
operators to modules.
"""

from tessera.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
