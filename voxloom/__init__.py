"""Speech-corpus analytics on Spark."""
