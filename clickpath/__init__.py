"""clickpath: web/app behaviour analytics on Spark.

Raw append-only event streams in; validated good/bad tables, a deduplicated
clock-trusted Parquet layer, sessions, journeys, traffic-source inference,
channel grouping and data-quality reports out.  Every public function is a
``DataFrame -> DataFrame`` or ``Column -> Column`` transformation.
"""

from clickpath.config import Config
from clickpath.session import build_spark, checkpoint_dir

__all__ = ["Config", "build_spark", "checkpoint_dir"]
