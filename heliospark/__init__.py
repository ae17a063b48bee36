"""heliospark: Spark-native hourly solar / weather analytics operators."""

__version__ = "0.1.0"
