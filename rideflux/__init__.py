"""rideflux: Spark-native ride-event analytics (batch and Structured Streaming)."""

__version__ = "0.1.0"
