"""A Spark-native analytics engine for bibliographic corpora."""
