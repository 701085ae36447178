"""flightloom: a Spark-native engine for periodic traffic statistics."""

__version__ = "0.1.0"
