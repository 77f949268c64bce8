"""Spark-native medallion pipeline for weather-station rainfall observations.

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame ->
DataFrame steps), ``sources`` (reads, writes, tables, SQL), ``plans`` (the
bronze and silver jobs), ``streaming`` (the incremental stream).
"""

__version__ = "0.1.0"
