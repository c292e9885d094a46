"""chatloom: Spark-native analytics over customer-service conversation logs."""

__version__ = "0.1.0"
