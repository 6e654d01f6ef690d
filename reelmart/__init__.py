"""reelmart: a Spark-native analytics mart library.

Raw semi-structured payloads go in; typed staging tables, bridge and
dimension tables, an upserted fact, a daily snapshot fact, aggregate marts,
data-quality checks, profiles and serving queries come out. Every operator
takes and returns ``pyspark.sql.DataFrame`` (or ``Column``) and is built from
built-in Spark SQL functions so that the work stays on the executors.
"""

from reelmart.config import MartConfig

__all__ = ["MartConfig"]
