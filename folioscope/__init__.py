"""folioscope: a Spark-native engine for document knowledge bases and hybrid retrieval."""

__version__ = "0.1.0"
