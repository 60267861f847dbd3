"""moodline: Spark-native sentiment x fulfilment analytics.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; Catalyst and AQE choose the physical plan.
"""

__version__ = "0.1.0"
