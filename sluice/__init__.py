"""sluice: batch and streaming data-movement operators on PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL functions, so Catalyst sees one lazy plan per job and can push
filters and projections into the scans.
"""

from sluice.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
