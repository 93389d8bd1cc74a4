"""A Spark-native engine for building datasets of timed recordings and transcripts."""
